"""Queries of problems 2 and 6 to 8, with production parameters over whole tables, and SQL for what SQL can express of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import filled
from ..operators.scratch import Scratch
from ..sources.tables import table
from . import mixing, packing, sampling, tokens, truncation


#: Shares of single strata (num_tipo_if, '' where it is NULL), beside the tenth of all others.
RATES = (("49", 0.05), ("81", 0.20), ("", 0.50))
#: A later run asks for less in general and for more in one stratum.
LATER = sampling.SampleConfig(rate=0.05, rates=(("96", 0.30),))
KEYED = ("num_if", "num_tipo_if", "num_carga")


def p2_amostra(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stable_sample(table(spark, d, "instrumento_financeiro"), *KEYED, sampling.SampleConfig()).withColumnRenamed("chave", "num_if")


def p2_limiares(spark: SparkSession, d: str) -> DataFrame:
    return sampling.thresholds(table(spark, d, "instrumento_financeiro"), *KEYED, sampling.SampleConfig())


def p2_estratos(spark: SparkSession, d: str) -> DataFrame:
    """Each stratum at its own rate."""
    return sampling.stable_sample(table(spark, d, "instrumento_financeiro"), *KEYED, sampling.SampleConfig(rates=RATES)).withColumnRenamed("chave", "num_if")


def p2_elevada(spark: SparkSession, d: str) -> DataFrame:
    """The run after p2_limiares: its thresholds hold where the new rates are lower, and are raised where they are higher."""
    df, scratch = table(spark, d, "instrumento_financeiro"), Scratch(spark, "p2")
    earlier = scratch.keep(sampling.thresholds(df, *KEYED, sampling.SampleConfig()).select("estrato", "limiar"))
    return sampling.stable_sample(df, *KEYED, LATER, earlier, scratch).withColumnRenamed("chave", "num_if")


def _packed(spark: SparkSession, d: str):
    scratch = Scratch(spark, "p6")
    docs = scratch.keep(tokens.sized(table(spark, d, "documents"), "doc_id", "text", []))
    boxes = table(spark, d, "recipiente").select("cod_recipiente", "capacidade_tokens").distinct().orderBy("cod_recipiente").collect()  # a few rows of metadata
    for code, capacity in boxes:
        items, makes = packing.pack(docs, "doc_id", capacity, scratch)
        yield code, capacity, items, makes


def p6_itens(spark: SparkSession, d: str) -> DataFrame:
    """Which text, or part of a long one, lies in which container, and the room left in it."""
    out = None
    for code, capacity, items, makes in _packed(spark, d):
        part = items.select(F.lit(code).alias("cod_recipiente"), "num_container", "doc_id", "parte", "token_de", "token_ate", "tokens")
        out = part if out is None else out.unionByName(part)
    return out


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for code, capacity, items, _ in _packed(spark, d):
        used = F.sum("tokens")
        part = items.groupBy("num_container").agg(F.count(F.lit(1)).alias("itens"), used.alias("tokens"), (F.lit(capacity) - used).alias("sobra")).select(F.lit(code).alias("cod_recipiente"), F.lit(capacity).alias("capacidade"), "num_container", "itens", "tokens", "sobra")
        out = part if out is None else out.unionByName(part)
    return out


def p6_resumo(spark: SparkSession, d: str) -> DataFrame:
    """Containers against the least number that could do, per capacity."""
    c = p6_containers(spark, d)
    return c.groupBy("cod_recipiente", "capacidade").agg(F.count(F.lit(1)).alias("containers"), F.ceil(F.sum("tokens") / F.first("capacidade")).alias("minimo"), F.sum("sobra").alias("sobra"), F.count_if(F.col("sobra") == 0).alias("cheios"))


def p6_conferencia(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every packing, counted over all items and containers: every document placed, no container over its capacity, no gap or overlap in a divided text, none divided without need."""
    out = None
    for code, capacity, items, _ in _packed(spark, d):
        per = items.groupBy("doc_id").agg(F.count(F.lit(1)).alias("p"), F.sum("tokens").alias("t"), F.max("token_ate").alias("ate"), F.min("token_de").alias("de"))
        docs = per.agg(
            F.count(F.lit(1)).alias("documentos"),
            F.count_if((F.col("de") != 0) | (F.col("t") != F.col("ate"))).alias("incompletos"),
            F.count_if((F.col("p") > 1) & (F.col("t") <= capacity) | (F.col("p") != F.greatest(F.ceil(F.col("t") / capacity), F.lit(1)))).alias("divididos_sem_necessidade"),
        )
        boxes = items.groupBy("num_container").agg(F.sum("tokens").alias("t")).agg(F.count_if(F.col("t") > capacity).alias("acima_da_capacidade"), (F.max("num_container") - F.count(F.lit(1))).alias("numeros_vagos"))
        one = F.lit(1).alias("__one")
        part = docs.select("*", one).join(F.broadcast(boxes.select("*", one)), "__one").drop("__one").select(F.lit(code).alias("cod_recipiente"), "*")  # a row each
        out = part if out is None else out.unionByName(part)
    return out


def _mixed(spark: SparkSession, d: str, choose=mixing.mixture):
    scratch = Scratch(spark, "p7")
    docs = scratch.keep(mixing.usable(tokens.sized(table(spark, d, "documents"), "doc_id", "text", ["source"])))
    sources = mixing.sources_of(docs, table(spark, d, "fonte_alvo"))
    mix = choose(sources)
    return mixing.collect_mixture(docs, sources, mix, scratch), sources, mix


def p7_colecao(spark: SparkSession, d: str) -> DataFrame:
    """The targets themselves (exponent 1), as large as the limits allow."""
    return _mixed(spark, d)[0]


def p7_fontes(spark: SparkSession, d: str) -> DataFrame:
    return mixing.report(*_mixed(spark, d))


def p7_fontes_orcamento(spark: SparkSession, d: str) -> DataFrame:
    """The report of a collection half as large as all documents with a target: the exponent is bisected to the largest that the limits of repetition allow under this budget."""
    return mixing.report(*_mixed(spark, d, lambda sources: mixing.mixture(sources, budget=sum(s.tokens for s in sources) / 2)))


def p7_fontes_entropia(spark: SparkSession, d: str) -> DataFrame:
    """The report of a collection whose entropy lies half way between that of the documents and that of the targets: the exponent is bisected to it."""

    def half_way(sources):
        natural, target = (mixing.entropy_of(mixing.blend(sources, a)) for a in (0.0, 1.0))
        return mixing.mixture(sources, entropy=(natural + target) / 2)

    return mixing.report(*_mixed(spark, d, half_way))


def p7_conferencia(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the collection, per source with a target: uses above the limit, documents of another source, and whether its tokens are further from its share than its longest document."""
    chosen, sources, mix = _mixed(spark, d)
    own = table(spark, d, "documents").select("doc_id", F.lower(filled(F.col("source"))).alias("__source"))
    per = chosen.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("u"), F.sum("tokens").alias("t"), F.max("tokens").alias("m")).join(own, "doc_id")
    plan = spark.createDataFrame([(s.name, s.limit, mix.budget * mix.share.get(s.name, 0.0)) for s in sources], "source string, limite int, meta double")
    used = plan.join(per, "source", "left").groupBy("source", "meta").agg(F.count_if(F.col("u") > F.col("limite")).alias("usos_acima_do_limite"), F.count_if(F.col("__source") != F.col("source")).alias("documentos_de_outra_fonte"), F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.max("m"), F.lit(0)).alias("m"))
    return used.select("source", "usos_acima_do_limite", "documentos_de_outra_fonte", (F.abs(F.col("t") - F.col("meta")) > F.col("m")).alias("longe_da_meta"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return truncation.judged(table(spark, d, "documents"), Scratch(spark, "p8"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).where("cortado").select("doc_id")


def p8_fontes(spark: SparkSession, d: str) -> DataFrame:
    return truncation.by_source(_judged(spark, d))


def p8_comprimentos(spark: SparkSession, d: str) -> DataFrame:
    """How many different texts of each source have each length, in each of the twelve ways of counting."""
    return truncation.histogram(Scratch(spark, "p8").keep(truncation.prepared(table(spark, d, "documents"))))


def p8_limites(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "p8")
    docs = scratch.keep(truncation.prepared(table(spark, d, "documents")))
    found = truncation.limits(docs).select("source", "codificacao", F.lit(None).cast("int").alias("bloco"), "limite", "textos", F.col("vizinhos").cast("double").alias("esperados"))
    blocks = truncation.block_limits(docs).select("source", "codificacao", "bloco", F.lit(None).cast("int").alias("limite"), "textos", "esperados")
    return found.unionByName(blocks)


QUERIES = {f.__name__: f for f in (p2_amostra, p2_limiares, p2_estratos, p2_elevada, p6_itens, p6_containers, p6_resumo, p6_conferencia, p7_colecao, p7_fontes, p7_fontes_orcamento, p7_fontes_entropia, p7_conferencia, p8_found, p8_fontes, p8_comprimentos, p8_limites)}


def _p2(fixed: str, chosen: bool = True) -> str:
    rows = f"(select *, {fixed} as l, substr(sha256('amostra-1:' || num_if), 1, 13) as h from (select num_if, coalesce(cast(num_tipo_if as varchar), '') as s, coalesce(num_carga, 2147483647) as g from instrumento_financeiro where num_if is not null))"
    best = "max({'l': l, 'c': -g, 's': s})"
    return f"(select num_if, x.s as estrato, g as carga, h, x.l as limiar from (select num_if, h, {best} as x, min(g) as g from {rows} where {'h < l' if chosen else 'true'} group by 1, 2))"


def _hex(rate: float) -> str:
    return f"'{int(rate * 16**13):013x}'"


def _rates(rates: dict[str, float], default: float) -> str:
    return "case s " + " ".join(f"when '{s}' then {_hex(r)}" for s, r in rates.items()) + f" else {_hex(default)} end"


BL = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
OUTER = BL + "".join(f" || chr({n})" for n in (0xA0, 0x85, 0x2007, 0x202F, 0x2028, 0x2029, 0x3000))


def _p8_lengths() -> str:
    times = lambda *signs: " + ".join(f"length(t) - length(replace(t, {s}, ''))" for s in signs)
    above = lambda code: f"length(regexp_replace(t, '[\\x{{00}}-\\x{{{code:X}}}]', '', 'g'))"
    nl, quote = times("chr(10)"), times("chr(34)")
    xml = f"4 * ({times('chr(38)')}) + 3 * ({times('chr(60)', 'chr(62)')}) + 5 * ({quote}) + 4 * ({times('chr(39)')})"
    entity = " + ".join([f"5 * {above(127)}", above(999), above(9999), above(99999)])
    json = f"({times('chr(10)', 'chr(34)', 'chr(92)', 'chr(9)', 'chr(13)', 'chr(8)', 'chr(12)')})"
    c, u = "length(t)", "strlen(t)"
    ways = {
        "caracteres": c, "utf8": u, "utf16": f"{c} + {above(65535)}", "crlf": f"{c} + {nl}", "crlf_utf8": f"{u} + {nl}", "xml": f"{c} + {xml}", "xml_utf8": f"{u} + {xml}",
        "entidades": f"{c} + {entity}", "xml_entidades": f"{c} + {xml} + {entity}", "json": f"{c} + {json}", "json_utf8": f"{u} + {json}", "json_ascii": f"{c} + {json} + 5 * {above(127)} + 6 * {above(65535)}",
    }
    docs = f"(select distinct coalesce(lower(nullif(trim(source, {BL}), '')), '') as source, text as t, rtrim(text, {OUTER}) as e from documents where nullif(trim(text, {BL}), '') is not null)"
    each = " union all ".join(f"select source, '{w}' as codificacao, e, {x} as n from {docs}" for w, x in ways.items())
    return f"select source, codificacao, n, count(distinct e) as textos from ({each}) group by 1, 2, 3"


SQL: dict[str, str] = {
    "p7_conferencia": f"select distinct lower(nullif(trim(source, {BL}), '')) as source, 0 as usos_acima_do_limite, 0 as documentos_de_outra_fonte, false as longe_da_meta from fonte_alvo where nullif(trim(source, {BL}), '') is not null",
    "p8_comprimentos": _p8_lengths(),
    "p2_amostra": f"select * from {_p2(_hex(0.10))}",
    "p2_limiares": f"select estrato, limiar, count(*) as chaves, count(*) filter (h < limiar) as escolhidas from {_p2(_hex(0.10), False)} group by 1, 2",
    "p2_estratos": f"select * from {_p2(_rates({'49': 0.05, '81': 0.20, '': 0.50}, 0.10))}",
    "p2_elevada": f"select * from {_p2(_rates({'96': 0.30}, 0.10))}",
    # tokens can't be counted in SQL: what must hold of the result can
    "p6_conferencia": "select distinct cod_recipiente, (select count(*) from documents) as documentos, 0 as incompletos, 0 as divididos_sem_necessidade, 0 as acima_da_capacidade, 0 as numeros_vagos from recipiente",
}
