"""Column-level data quality profile (problem 1): character-class masks per column and load.

Values are generalised to masks (digits 9, upper case A, lower case a). Counting masks per column and load gives the
dominant patterns, the rare ones (violations) and, between loads, how far their mask distributions diverge. Where a domain
or format is declared, a value behind a dominant or declared mask is checked exactly too, and masks are split by what
the declaration tells apart before loads are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import filled, mask, run_mask
from .scratch import Scratch

#: Letters of a declared date form and the pattern letters they stand for (fixed values).
FORM = {"AAAA": "yyyy", "MM": "MM", "DD": "dd", "HH": "HH", "SS": "ss"}


@dataclass(frozen=True)
class Rule:
    """What is legal in one column: codes, or a date form with its earliest date. ``table``'s rows have ``key`` and ``load``."""

    table: str
    column: str
    key: str
    load: str = "num_carga"
    codes: tuple[str, ...] = ()
    form: str | None = None
    least: str | None = None
    to_load_date: bool = False

    def masks(self) -> list[str]:
        """The masks that legal values have."""
        if self.form:
            return ["".join("9" if ch.isalpha() else ch for ch in self.form)]
        return sorted({"".join("9" if ch.isdigit() else "A" if ch.isupper() else ch for ch in c.upper()) for c in self.codes})

    def pattern(self) -> str:
        """The declared form as a datetime pattern; its MM is a month before the first HH and minutes after it."""
        head, hour, tail = (self.form or "").partition("HH")
        for a, b in FORM.items():
            head = head.replace(a, b)
        return head + hour + tail.replace("MM", "mm").replace("SS", "ss")


def rules_of(dominio: DataFrame, keys: dict[str, str]) -> list[Rule]:
    """The rules of a table of declared domains (tabela, coluna, tipo_regra, conteudo): metadata of a few rows a column."""
    parts: dict[tuple[str, str], dict] = {}
    for r in dominio.select("tabela", "coluna", "tipo_regra", "conteudo").distinct().collect():
        got = parts.setdefault((r.tabela, r.coluna), {"codes": set()})
        if r.tipo_regra == "valor":
            got["codes"].add(r.conteudo.strip().upper())
        elif r.tipo_regra == "formato":
            got["form"] = r.conteudo
        elif r.tipo_regra == "minimo":
            got["least"] = r.conteudo
        elif r.tipo_regra == "maximo":
            got["to_load_date"] = True
    return [Rule(t, c, keys[t], codes=tuple(sorted(p.pop("codes"))), **p) for (t, c), p in sorted(parts.items()) if t in keys]


def values(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """coluna (table.column), num_carga, chave, valor (NULL if empty), mascara of a table's ruled columns, in one scan; codes without regard to case. No shuffle.

    ``rules`` are those of one table, with one key and load.
    """
    text = [filled(F.col(r.column)) for r in rules]
    each = F.array(*(F.struct(F.lit(f"{r.table}.{r.column}").alias("coluna"), (F.upper(v) if r.codes else v).alias("valor")) for r, v in zip(rules, text)))
    rows = df.select(F.col(rules[0].load).cast("int").alias("num_carga"), F.col(rules[0].key).cast("bigint").alias("chave"), F.explode(each).alias("__e"))
    return rows.select("__e.coluna", "num_carga", "chave", "__e.valor").withColumn("mascara", mask(F.col("valor")))


def _per_rule(rules: list[Rule], make: Callable[[Rule], Column]) -> Column:
    """``make`` of the row's rule: a branch a declared column."""
    out = F.lit(None)
    for r in rules:
        out = F.when(F.col("coluna") == f"{r.table}.{r.column}", make(r)).otherwise(out)
    return out


def _declared(rule: Rule) -> Column:
    """Whether the value's mask is one that the declaration allows."""
    return F.col("mascara").isin(rule.masks())


def _time(rule: Rule) -> Column:
    """The time that a value of the declared form names; NULL if it is none."""
    return F.try_to_timestamp(F.when(_declared(rule), F.col("valor")), F.lit(rule.pattern())).cast("timestamp_ntz")


def _class(rule: Rule) -> Column:
    """What a value counts as: '' if empty, the legal code, the day of a well-formed date, '?' if it is neither. It splits a declared mask by what the declaration tells apart."""
    known = F.when(_declared(rule) & F.col("valor").isin(list(rule.codes)), F.col("valor")) if rule.codes else F.date_format(_time(rule), "yyyy-MM-dd")
    return F.when(F.col("valor").isNull(), "").otherwise(F.coalesce(known, F.lit("?")))


def class_counts(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """coluna, num_carga, mascara, grupo, n of rows as of ``values``: masks, split by what the declared domain tells apart."""
    return rows.groupBy("coluna", "num_carga", "mascara", _per_rule(rules, _class).alias("grupo")).agg(F.count(F.lit(1)).alias("n"))


def value_cases(rows: DataFrame, counts: DataFrame, rules: list[Rule], loads: DataFrame, config: ProfileConfig) -> DataFrame:
    """Rows (as of ``values``, each once) whose value is illegal: coluna, num_carga, chave, achado (dominio, formato, faixa).

    The masks of each column over all loads are mined first (``counts``). A rare mask that the declaration does not know
    is a violation by itself; a value behind a dominant or a declared mask is checked exactly: its code against the list,
    its date against calendar and bounds. ``loads`` (a fixed few rows: num_carga, dat_carga) bounds dates. A row without a
    load, or of an unknown one, has no upper bound.
    """
    common = patterns(counts.groupBy("coluna", "num_carga", "mascara").agg(F.sum("n").alias("n"), F.lit(None).cast("string").alias("exemplo")), config).where("dominante").select("coluna", "mascara", F.lit(True).alias("__common"))
    most = loads.select("num_carga", F.col("dat_carga").cast("timestamp_ntz").alias("__most")).groupBy("num_carga").agg(F.max("__most").alias("__most"))
    # at most 1 / dominant masks a column, and a row a load
    v = rows.where(F.col("valor").isNotNull()).join(F.broadcast(common), ["coluna", "mascara"], "left").join(F.broadcast(most), "num_carga", "left")
    strange = F.col("__common").isNull()

    def judge(r: Rule) -> Column:
        off = strange & ~_declared(r)
        if r.codes:
            return F.when(off | ~F.col("valor").isin(list(r.codes)), "dominio")
        least = F.col("__at") < F.lit(r.least).cast("timestamp_ntz") if r.least else F.lit(False)
        late = F.coalesce(F.col("__at") > F.col("__most"), F.lit(False)) if r.to_load_date else F.lit(False)
        return F.when(off | F.col("__at").isNull(), "formato").when(least | late, "faixa")

    dated = [r for r in rules if not r.codes]
    v = v.withColumn("__at", _per_rule(dated, _time) if dated else F.lit(None).cast("timestamp_ntz"))
    return v.withColumn("achado", _per_rule(rules, judge)).where(F.col("achado").isNotNull()).select("coluna", "num_carga", "chave", "achado")


def divergence(counts: DataFrame) -> DataFrame:
    """coluna, num_carga, divergencia: half the sum of absolute differences between a load's shares of groups and all loads' shares.

    ``counts``: coluna, num_carga, grupo, n. Works on the counts alone; loads that miss a group count it as 0. Empty in, empty out.
    """
    totals = counts.groupBy("coluna", "grupo").agg(F.sum("n").alias("__m"))
    whole = totals.groupBy("coluna").agg(F.sum("__m").alias("__t"))  # a row a column
    loads = counts.groupBy("coluna", "num_carga").agg(F.sum("n").alias("__l"))
    p = totals.join(F.broadcast(whole), "coluna").select("coluna", "grupo", (F.col("__m") / F.col("__t")).alias("__p"))
    # sum |p - q| over the groups of a load, plus p of the groups that it misses (1 - sum p of those it has)
    q = counts.alias("c").join(loads.alias("l"), (F.col("c.coluna") == F.col("l.coluna")) & F.col("c.num_carga").eqNullSafe(F.col("l.num_carga"))).select("c.coluna", "c.num_carga", "c.grupo", (F.col("c.n") / F.col("l.__l")).alias("__q"))
    each = q.join(p, ["coluna", "grupo"]).groupBy("coluna", "num_carga").agg(F.sum(F.abs(F.col("__q") - F.col("__p"))).alias("__d"), F.sum("__p").alias("__have"))
    return each.select("coluna", "num_carga", ((F.col("__d") + 1 - F.col("__have")) / 2).alias("divergencia"))


def load_cases(counts: DataFrame, rules: list[Rule], nulls: float = 0.15, mix: float = 0.30, day: float = 0.40, least: int = 10) -> DataFrame:
    """coluna, num_carga, achado (nulos, distribuicao, concentracao) from ``class_counts``.

    nulos: the share of the empty mask against the median load's. distribuicao: the divergence of the legal masks, each
    split by code. concentracao: one day among the dates.
    """
    counts = counts.groupBy("coluna", "num_carga", "grupo").agg(F.sum("n").alias("n"))
    n, named = F.col("n"), ~F.col("grupo").isin("", "?")
    coded = [f"{r.table}.{r.column}" for r in rules if r.codes]
    per = counts.groupBy("coluna", "num_carga").agg((F.sum(F.when(F.col("grupo") == "", n).otherwise(0)) / F.sum(n)).alias("__empty"), F.max(F.when(named, n)).alias("__top"), F.sum(F.when(named, n)).alias("__formed"))
    mid = per.withColumn("__mid", F.median("__empty").over(Window.partitionBy("coluna")))  # a row a load
    out = mid.where(F.abs(F.col("__empty") - F.col("__mid")) > nulls).select("coluna", "num_carga", F.lit("nulos").alias("achado"))
    far = divergence(counts.where(named & F.col("coluna").isin(coded))).where(F.col("divergencia") > mix)
    dense = per.where(~F.col("coluna").isin(coded) & (F.col("__formed") >= least) & (F.col("__top") / F.col("__formed") > day))
    return out.unionByName(far.select("coluna", "num_carga", F.lit("distribuicao").alias("achado"))).unionByName(dense.select("coluna", "num_carga", F.lit("concentracao").alias("achado")))


def found(tables: dict[str, DataFrame], rules: list[Rule], loads: DataFrame, scratch: Scratch, config: ProfileConfig | None = None) -> DataFrame:
    """tabela, coluna, achado, num_carga, chave: all value cases, and load cases with chave 0.

    Each table is scanned once, whatever its rules; repeated rows count once. No rules, or empty tables: no rows.
    """
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        by_table.setdefault(r.table, []).append(r)
    rows = scratch.keep(reduce(DataFrame.unionByName, (values(tables[t], rs) for t, rs in by_table.items())).distinct())
    counts = scratch.keep(class_counts(rows, rules))
    cases = value_cases(rows, counts, rules, loads, config or ProfileConfig())
    both = cases.unionByName(load_cases(counts, rules).withColumn("chave", F.lit(0).cast("bigint")))
    at = F.split(F.col("coluna"), r"\.")
    return both.select(at[0].alias("tabela"), at[1].alias("coluna"), "achado", "num_carga", "chave")


@dataclass(frozen=True)
class ProfileConfig:
    """dominant: a mask is dominant in its column from this share of the filled values on; rare below it."""

    dominant: float = 0.01
    load: str = "num_carga"
    skip: tuple[str, ...] = field(default=())


def long_values(df: DataFrame, load: str) -> DataFrame:
    """num_carga, coluna, valor of every column of the distinct rows: one row a field, unpivoted in the scan's stage."""
    cols = [c for c in df.columns if c != load]
    rows = df.distinct()
    each = F.array(*(F.struct(F.lit(c).alias("coluna"), filled(F.col(f"`{c}`")).alias("valor")) for c in cols))
    return rows.select(F.col(load).cast("int").alias("num_carga"), F.explode(each).alias("__e")).select("num_carga", "__e.coluna", "__e.valor")


def mask_counts(df: DataFrame, config: ProfileConfig = ProfileConfig(), form: Callable[[Column], Column] = run_mask) -> DataFrame:
    """coluna, num_carga, mascara, n, exemplo (least value): mask counts of every column and load; NULL mask = empty.

    ``form``: ``run_mask`` shortens the runs of every value, so long texts have short masks, but values that differ only
    in length or in how they fall into words share one; ``mask`` keeps both apart, and its masks are as long as the
    values. Combined before the shuffle.
    """
    v = long_values(df, config.load).withColumn("mascara", form(F.col("valor")))
    return v.groupBy("coluna", "num_carga", "mascara").agg(F.count(F.lit(1)).alias("n"), F.min("valor").alias("exemplo"))


def patterns(counts: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """coluna, mascara, n, parte, dominante: the masks of each column over all loads, and whether they are dominant."""
    per = counts.where(F.col("mascara").isNotNull()).groupBy("coluna", "mascara").agg(F.sum("n").alias("n"), F.min("exemplo").alias("exemplo"))
    total = per.groupBy("coluna").agg(F.sum("n").alias("__t"))
    share = F.col("n") / F.col("__t")
    return per.join(F.broadcast(total), "coluna").select("coluna", "mascara", "n", "exemplo", share.alias("parte"), (share >= config.dominant).alias("dominante"))  # a row a column


def rare(counts: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """coluna, num_carga, mascara, n, exemplo of masks that aren't dominant in their column: pattern violations by load."""
    few = patterns(counts, config).where(F.col("dominante")).select("coluna", "mascara")  # up to 1 / dominant rows a column
    return counts.where(F.col("mascara").isNotNull()).join(F.broadcast(few), ["coluna", "mascara"], "left_anti").select("coluna", "num_carga", "mascara", "n", "exemplo")


def mask_divergence(counts: DataFrame) -> DataFrame:
    """coluna, num_carga, divergencia of a load's mask distribution from all loads' (half the sum of absolute differences), empty values as a mask."""
    return divergence(counts.select("coluna", "num_carga", F.coalesce("mascara", F.lit("")).alias("grupo"), "n"))


def column_profile(df: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """coluna, num_carga, linhas, vazios, distintos, minimo, maximo (as text) of every column and load.

    Exact distinct counts from one count by value, combined before the shuffle; the hottest value is one row by then.
    Numbers compare as numbers, all else as text, without outer blanks.
    """
    v = long_values(df, config.load).groupBy("coluna", "num_carga", "valor").agg(F.count(F.lit(1)).alias("n"))
    num = F.col("valor").try_cast("double")
    return v.groupBy("coluna", "num_carga").agg(
        F.sum("n").alias("linhas"),
        F.sum(F.when(F.col("valor").isNull(), F.col("n")).otherwise(0)).alias("vazios"),
        F.count("valor").alias("distintos"),
        F.max("n").alias("n_mais_comum"),
        F.min("valor").alias("minimo_texto"),
        F.max("valor").alias("maximo_texto"),
        F.min(num).alias("minimo_numero"),
        F.max(num).alias("maximo_numero"),
    )


__all__ = ["ProfileConfig", "Rule", "class_counts", "column_profile", "divergence", "found", "load_cases", "mask_counts", "mask_divergence", "patterns", "rare", "rules_of", "value_cases", "values"]
