"""Queries of the general problems 1 and 3 to 5, with production parameters over whole tables, and their SQL where it is fast enough."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import mask
from ..operators import compare, hierarchy, profile, references
from ..operators.scratch import Scratch
from ..sources.tables import table

RULED = {"instrumento_financeiro": "num_if", "titulo": "num_if", "resgate": "num_condicao_if"}
ACTIVE_CONTA = r"coalesce(btrim(ind_excluido), '') in ('S', 'Y', '1')"
REFERENCES = [
    references.Reference("carteira_comitente", "num_id_entidade", "num_carteira_comitente", "dat_exclusao is not null", "dat_inclusao", "comitente", "num_id_entidade", "dat_exclusao is not null", "dat_inclusao"),
    references.Reference("carteira_comitente", "num_conta", "num_carteira_comitente", "dat_exclusao is not null", "dat_inclusao", "conta", "num_conta", ACTIVE_CONTA, "dat_inclusao"),
    references.Reference("operacao", "num_id_ctx_msg_p2", "num_id_operacao", "dat_exclusao is not null", "dat_inclusao", "contexto_mensagem", "num_id_ctx_msg", "dat_exclusao is not null", "dat_inclusao"),
]
PARENTS = {"pertence": "num_if_pertence", "origem": "num_if_origem"}
COPIES = {"comitente": ("comitente_destino", "num_id_entidade"), "conta": ("conta_destino", "num_conta")}


def _ruled(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {t: table(spark, d, t) for t in RULED}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    rules = profile.rules_of(table(spark, d, "dominio_coluna"), RULED)
    return profile.found(_ruled(spark, d), rules, table(spark, d, "carga"), Scratch(spark, "p1"))


def _each(spark: SparkSession, d: str, make) -> DataFrame:
    out = None
    for t, df in _ruled(spark, d).items():
        part = make(df).select(F.lit(t).alias("tabela"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def p1_perfil(spark: SparkSession, d: str) -> DataFrame:
    return _each(spark, d, profile.column_profile)


def p1_padroes(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "p1")
    return _each(spark, d, lambda df: profile.patterns(scratch.keep(profile.mask_counts(df))))


def p1_mascaras_raras(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "p1")
    return _each(spark, d, lambda df: profile.rare(scratch.keep(profile.mask_counts(df))))


def p1_divergencia(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "p1")
    return _each(spark, d, lambda df: profile.mask_divergence(scratch.keep(profile.mask_counts(df)))).withColumn("divergencia", F.round("divergencia", 9))


def p1_padroes_exatos(spark: SparkSession, d: str) -> DataFrame:
    """p1_padroes on exact masks: length and division into words count."""
    scratch = Scratch(spark, "p1")
    return _each(spark, d, lambda df: profile.patterns(scratch.keep(profile.mask_counts(df, form=mask))))


def p1_mascaras_raras_exatas(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "p1")
    return _each(spark, d, lambda df: profile.rare(scratch.keep(profile.mask_counts(df, form=mask))))


def p1_divergencia_exata(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "p1")
    return _each(spark, d, lambda df: profile.mask_divergence(scratch.keep(profile.mask_counts(df, form=mask)))).withColumn("divergencia", F.round("divergencia", 9))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    names = {r.table for r in REFERENCES} | {r.target for r in REFERENCES}
    return references.orphans({t: table(spark, d, t) for t in names}, REFERENCES, Scratch(spark, "p3"))


def p3_periodos(spark: SparkSession, d: str) -> DataFrame:
    return p3_found(spark, d).groupBy("tabela", "coluna", "periodo", "situacao").agg(F.count(F.lit(1)).alias("n"))


def p3_contagens(spark: SparkSession, d: str) -> DataFrame:
    """Signed counts of the orphan keys: positive references, no existence (repeated rows counted as often as they come)."""
    parts = []
    for t in ("carteira_comitente", "operacao"):
        parts.append(references.reference_deltas(references.referring(table(spark, d, t).distinct(), [r for r in REFERENCES if r.table == t])))
    parts += [references.existence_deltas(table(spark, d, r.target).distinct(), r) for r in REFERENCES]
    state = references.fold(*parts).where((F.col("refs") > 0) & (F.col("active") <= 0))
    return state.select(F.col("__ref").alias("referencia"), F.col("__key").alias("chave"), "refs", "active", "ever")


def _tree(spark: SparkSession, d: str, paths: bool = True, alone: bool = True) -> DataFrame:
    return hierarchy.hierarchy(table(spark, d, "instrumento_financeiro"), "num_if", PARENTS, Scratch(spark, "p4"), paths, alone)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d, paths=False, alone=False).where("linked").select(F.col("h").alias("hierarquia"), F.col("id").alias("num_if"), F.col("root").alias("num_if_raiz"), F.col("depth").alias("profundidade"))


def p4_caminhos(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d).select(F.col("h").alias("hierarquia"), F.col("id").alias("num_if"), F.col("root").alias("num_if_raiz"), F.col("depth").alias("profundidade"), F.concat_ws("/", F.col("path").cast("array<string>")).alias("caminho"), F.col("size").alias("tamanho"))


def p4_descendentes(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.descendants(_tree(spark, d, alone=False)).select(F.col("h").alias("hierarquia"), F.col("ancestor").alias("num_if"), F.col("id").alias("num_if_abaixo"), F.col("steps").alias("passos"))


def p4_circulos(spark: SparkSession, d: str) -> DataFrame:
    ring = hierarchy.circle_members(table(spark, d, "instrumento_financeiro"), "num_if", PARENTS, Scratch(spark, "p4"))
    return ring.select(F.col("h").alias("hierarquia"), F.col("circle").alias("circulo"), F.col("id").alias("num_if"))


def _diffs(spark: SparkSession, d: str):
    scratch = Scratch(spark, "p5")
    for t, (copy, key) in COPIES.items():
        yield t, compare.differences(table(spark, d, t), table(spark, d, copy), key, scratch)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for t, diff in _diffs(spark, d):
        part = compare.found(diff, t)
        out = part if out is None else out.unionByName(part)
    return out


def p5_diferencas(spark: SparkSession, d: str) -> DataFrame:
    """Field by field: chave, campo, esquerda, direita of every difference."""
    out = None
    for t, diff in _diffs(spark, d):
        part = diff.where(F.col("situacao") == "valor").select(F.lit(t).alias("tabela"), "chave", "versao", F.inline("difs"))
        out = part if out is None else out.unionByName(part)
    return out


def p5_versoes(spark: SparkSession, d: str) -> DataFrame:
    """Copies of a table whose key isn't unique: comitente keyed by its situation, of which every value has many rows."""
    diff = compare.differences(table(spark, d, "comitente"), table(spark, d, "comitente_destino"), "num_id_situacao_comitente", Scratch(spark, "p5"))
    return diff.where("situacao <> 'igual'").select("chave", "versao", "situacao", F.inline("difs"))


def p5_resumo(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for t, diff in _diffs(spark, d):
        part = diff.groupBy("situacao").agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tabela"), "situacao", "n")
        out = part if out is None else out.unionByName(part)
    return out


QUERIES = {f.__name__: f for f in (p1_found, p1_perfil, p1_padroes, p1_mascaras_raras, p1_divergencia, p1_padroes_exatos, p1_mascaras_raras_exatas, p1_divergencia_exata, p3_found, p3_periodos, p3_contagens, p4_found, p4_caminhos, p4_descendentes, p4_circulos, p5_found, p5_diferencas, p5_versoes, p5_resumo)}
