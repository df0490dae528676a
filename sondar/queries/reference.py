"""Queries of the general relational operators: checks, joins, closure, clones, ordinals, selection, shapes, similarity, statistics, sets, publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import checks, clone, closure, dates, keys, prefix, preflight, repair, selection, shape, similarity, stats
from ..operators.scratch import Scratch
from ..operators.skew import salted_join
from ..plans import catalog
from ..sources import catalogue, publish
from ..sources.tables import table

QUERIES = {}
TODAY = "2026-06-30"


def query(f):
    QUERIES[f.__name__] = f
    return f


def _t(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [table(spark, d, n) for n in names]


# --- constraint checks ------------------------------------------------------------------------------------------------


@query
def chk_not_null_events(spark, d):
    (df,) = _t(spark, d, "events")
    return checks.count_checks(df, "events", checks.column_checks(df, df.columns, {}, {}))


@query
def chk_not_null_instrumento(spark, d):
    (df,) = _t(spark, d, "instrumento_financeiro")
    return checks.count_checks(df, "instrumento_financeiro", checks.column_checks(df, df.columns, {}, {}))


@query
def chk_decimal_domain_lineitem(spark, d):
    (df,) = _t(spark, d, "lineitem")
    return checks.count_checks(df, "lineitem", checks.column_checks(df, [], {"l_extendedprice": (6, 2), "l_quantity": (3, 2), "l_discount": (1, 1)}, {}))


@query
def chk_varchar_domain_part(spark, d):
    (df,) = _t(spark, d, "part")
    return checks.count_checks(df, "part", checks.column_checks(df, [], {}, {"p_name": 10, "p_brand": 7, "p_type": 8}))


@query
def chk_pk_unique_lineitem(spark, d):
    return checks.pk_unique(*_t(spark, d, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


@query
def chk_pk_unique_contexto(spark, d):
    return checks.pk_unique(*_t(spark, d, "contexto_mensagem"), "contexto_mensagem", ["num_id_ctx_msg"])


@query
def chk_pk_collision_instrumento_titulo(spark, d):
    a, b = _t(spark, d, "instrumento_financeiro", "titulo")
    return checks.pk_collision(a, b, "instrumento_financeiro", ["num_if"])


@query
def chk_fk_lineitem_orders(spark, d):
    a, b = _t(spark, d, "lineitem", "orders")
    return checks.fk(a, [b], "lineitem", ["l_orderkey"], ["o_orderkey"])


@query
def chk_fk_titulo_instrumento(spark, d):
    a, b = _t(spark, d, "titulo", "instrumento_financeiro")
    return checks.fk(a, [b], "titulo", ["num_if"], ["num_if"]).unionByName(checks.fk(a, [b], "titulo", ["num_if"], ["num_if"], distinct=False).withColumn("verificacao", F.lit("fk_linhas")))


@query
def chk_fk_orders_customer_union_parents(spark, d):
    o, c, s = _t(spark, d, "orders", "customer", "supplier")
    return checks.fk(o, [c.select("c_custkey"), s.select(F.col("s_suppkey").alias("c_custkey"))], "orders", ["o_custkey"], ["c_custkey"])


@query
def chk_unique_customer_name(spark, d):
    return checks.unique(*_t(spark, d, "customer"), "customer", ["c_name"])


@query
def chk_unique_instrumento_cod_if(spark, d):
    return checks.unique(*_t(spark, d, "instrumento_financeiro"), "instrumento_financeiro", ["cod_if"])


@query
def chk_profile_one_pass_orders(spark, d):
    (df,) = _t(spark, d, "orders")
    return checks.one_pass_profile(df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), [["o_custkey"], ["o_custkey", "o_orderstatus"]])


@query
def chk_octet_length_documents(spark, d):
    (df,) = _t(spark, d, "documents")
    v = F.octet_length("text")
    return df.groupBy("lang").agg(F.max(v).alias("octetos"), F.max(F.length("text")).alias("caracteres"), F.count_if(v > 4000).alias("acima_4000"))


SPECS = {
    "public.customer": {"pk_cols": ["c_custkey"], "foreign_keys": [{"columns": ["c_nationkey"], "parent_table": "nation", "parent_columns": ["n_nationkey"]}]},
    "orders": {"pk_cols": ["o_orderkey"], "fks": [{"columns": ["o_custkey"], "parent_table": "CUSTOMER", "parent_columns": ["c_custkey"]}]},
    "lineitem": {"pk_cols": ["l_orderkey", "l_linenumber"], "fks": [{"columns": ["l_orderkey"], "parent_table": "orders", "parent_columns": ["o_orderkey"]}, {"columns": ["l_partkey"], "parent_table": "warehouse", "parent_columns": ["w_id"]}]},
    "nation": {"pk_cols": ["n_nationkey"], "static": True},
}


@query
def chk_validate_all(spark, d):
    """Every check that specs ask for, over three tables; one parent table is not there and comes out as not verifiable."""
    specs = catalog.normalise(SPECS)
    names = {"CUSTOMER": "customer", "ORDERS": "orders", "LINEITEM": "lineitem", "NATION": "nation"}
    frames = {k: table(spark, d, v).toDF(*[c.upper() for c in table(spark, d, v).columns]) for k, v in names.items()}
    schemas = {"ORDERS": catalog.TableSchema({"O_ORDERKEY": catalog.ColumnRule(False, 9, 0), "O_ORDERPRIORITY": catalog.ColumnRule(True, None, 0, 8)}, (("O_CUSTKEY",),))}
    return checks.validate(frames, specs, schemas)


@query
def chk_classify_orphans(spark, d):
    """Titles without an active instrument: lost on the way if the source has the instrument at all."""
    t, i = _t(spark, d, "titulo", "instrumento_financeiro")
    return checks.classify_orphans(t, ["num_if"], keys.active_declared(i, "dat_exclusao"), ["num_if"], i)


@query
def chk_two_paths(spark, d):
    """Operations whose own code differs from their instrument's: two ways to the same fact."""
    o, i = _t(spark, d, "operacao", "instrumento_financeiro")
    codes = i.groupBy("num_if").agg(F.min(F.upper(F.trim("cod_if"))).alias("codigo"))
    both = salted_join(o.select("num_id_operacao", "num_if", F.upper(F.trim("cod_if")).alias("proprio")).distinct(), codes, ["num_if"], "inner", ["num_id_operacao"])
    return both.where(~F.col("proprio").eqNullSafe(F.col("codigo"))).select("num_id_operacao", "num_if", "proprio", "codigo")


@query
def chk_active_variants(spark, d):
    """Active rows under each of the row-state rules."""
    i, c = _t(spark, d, "instrumento_financeiro", "conta")
    return stats.counts({"declarada": keys.active_declared(i, "dat_exclusao"), "primeira": keys.active_first(i, ["IND_EXCLUIDO", "DAT_EXCLUSAO"]), "nula": keys.active_null(i, "dat_exclusao"), "sinalizada": keys.active_declared(c, "ind_excluido")})


@query
def key_forms(spark, d):
    """The key forms side by side, on text keys of every make."""
    (c,) = _t(spark, d, "carteira_comitente")
    k = F.col("num_conta")
    return c.select("num_conta").distinct().select("num_conta", keys.norm_key(k).alias("norm_key"), keys.norm_code(k).alias("norm_code"), keys.canon_key(k).alias("canon_key"), keys.fk_key(k, False).alias("fk_text"))


# --- joins ------------------------------------------------------------------------------------------------------------


@query
def join_inner_collision(spark, d):
    a, b = _t(spark, d, "instrumento_financeiro", "titulo")
    return a.select("num_if").distinct().join(b.select("num_if").distinct(), "num_if")


@query
def join_anti_orders_without_lineitem(spark, d):
    o, li = _t(spark, d, "orders", "lineitem")
    return o.join(li.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@query
def join_semi_customers_with_orders(spark, d):
    c, o = _t(spark, d, "customer", "orders")
    return c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


@query
def join_left_coalesce_remap(spark, d):
    """Accounts in their copy's number where there is one, else their own."""
    c, x = _t(spark, d, "carteira_comitente", "conta")
    small = x.groupBy(F.col("num_conta").alias("__key")).agg(F.min("cod_conta").alias("codigo"))
    left = c.select("num_carteira_comitente", keys.norm_key(F.col("num_conta")).try_cast("bigint").alias("__key"), "num_conta").distinct()
    return salted_join(left, small, ["__key"], "left", ["num_carteira_comitente"]).select("num_carteira_comitente", F.coalesce("codigo", F.trim("num_conta")).alias("conta"))


@query
def join_cross_k(spark, d):
    (n,) = _t(spark, d, "nation")
    return clone.multiply(n, 4).select("n_nationkey", "n_name", F.col(clone.K).alias("k"))


@query
def join_full_outer_compare(spark, d):
    a, b = _t(spark, d, "comitente", "comitente_destino")
    same = b.dropDuplicates().select(keys.norm_key(F.col("num_id_entidade")).try_cast("bigint").alias("num_id_entidade"), "nom_comitente", "num_id_situacao_comitente")
    return repair.frame_differences(a.select("num_id_entidade", "nom_comitente", "num_id_situacao_comitente").distinct(), same, ["num_id_entidade"])


@query
def join_theta_pairs(spark, d):
    """Unordered pairs of nations in one region: an equi join with a residual <."""
    (n,) = _t(spark, d, "nation")
    a, b = n.select("n_regionkey", F.col("n_name").alias("nacao_a")), n.select("n_regionkey", F.col("n_name").alias("nacao_b"))
    return a.join(b, "n_regionkey").where("nacao_a < nacao_b")


@query
def join_bridge_lineitem_to_customer(spark, d):
    """Lines attributed to their customer by way of the order."""
    li, o = _t(spark, d, "lineitem", "orders")
    both = li.select("l_orderkey", "l_quantity").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    return both.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("linhas"), F.sum("l_quantity").alias("quantidade"))


@query
def join_marker_nullify(spark, d):
    """Account references that the account table lacks, set to NULL; all else as it was."""
    c, x = _t(spark, d, "carteira_comitente", "conta")
    lost = selection.missing_keys(c, "num_conta", x, "num_conta", "carteira_comitente")
    return repair.repair(c.select("num_carteira_comitente", "num_conta"), "num_conta", lost, "carteira_comitente", Scratch(spark, "marker"))


@query
def repair_report(spark, d):
    c, x = _t(spark, d, "carteira_comitente", "conta")
    c = c.select("num_carteira_comitente", "num_conta", "num_if").distinct()
    lost = selection.missing_keys(c, "num_conta", x, "num_conta", "carteira_comitente")
    return repair.repair_report(c, repair.repair(c, "num_conta", lost, "carteira_comitente", Scratch(spark, "repair")), "num_conta", ["num_carteira_comitente"])


def _closure(spark, d, scratch):
    c, o, li = _t(spark, d, "customer", "orders", "lineitem")
    raw = {"CUSTOMER": {"pk_cols": ["C_CUSTKEY"]}, "ORDERS": {"pk_cols": ["O_ORDERKEY"], "fks": [{"columns": ["C_CUSTKEY"], "parent_table": "CUSTOMER", "parent_columns": ["C_CUSTKEY"]}]}, "LINEITEM": {"pk_cols": ["O_ORDERKEY", "L_LINENUMBER"], "fks": [{"columns": ["O_ORDERKEY"], "parent_table": "ORDERS", "parent_columns": ["O_ORDERKEY"]}]}}
    plans = catalog.clone_plans(catalog.normalise(raw), "CUSTOMER", {"CUSTOMER": {"C_CUSTKEY"}, "ORDERS": {"O_ORDERKEY"}})
    frames = {"CUSTOMER": c, "ORDERS": o.withColumnRenamed("o_custkey", "c_custkey"), "LINEITEM": li.withColumnRenamed("l_orderkey", "o_orderkey")}
    roots = c.where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return closure.closure(frames, plans, "CUSTOMER", roots, scratch), frames


@query
def closure_customer_orders_lineitem(spark, d):
    prov, _ = _closure(spark, d, Scratch(spark, "closure"))
    out = None
    for t, p in prov.items():
        part = p.agg(F.count(F.lit(1)).alias("linhas"), F.count_distinct(closure.ROOT).alias("raizes")).select(F.lit(t).alias("tabela"), "linhas", "raizes")
        out = part if out is None else out.unionByName(part)
    return out


@query
def closure_provenance_orders(spark, d):
    prov, _ = _closure(spark, d, Scratch(spark, "closure"))
    return prov["ORDERS"].select(F.col("O_ORDERKEY").alias("o_orderkey"), F.col(closure.ROOT).alias("raiz"))


def _sampling_specs():
    return catalog.normalise({"NATION": {"pk_cols": ["n_nationkey"]}, "CUSTOMER": {"pk_cols": ["c_custkey"], "fks": [{"columns": ["c_nationkey"], "parent_table": "NATION", "parent_columns": ["n_nationkey"]}]}, "ORDERS": {"pk_cols": ["o_orderkey"], "fks": [{"columns": ["o_custkey"], "parent_table": "CUSTOMER", "parent_columns": ["c_custkey"]}]}})


def _upper(spark, d, *names):
    return {n.upper(): (df := table(spark, d, n)).toDF(*[c.upper() for c in df.columns]) for n in names}


@query
def referential_downsample(spark, d):
    """Customers and orders of the nations of one region."""
    frames = _upper(spark, d, "nation", "customer", "orders")
    kept = closure.downsample(frames, _sampling_specs(), {"NATION": frames["NATION"].where("N_REGIONKEY = 1")}, Scratch(spark, "down"))
    return kept["ORDERS"].select(F.col("O_ORDERKEY").alias("o_orderkey"), F.col("O_CUSTKEY").alias("o_custkey"))


@query
def referential_upclosure(spark, d):
    """All parents of the urgent orders."""
    frames = _upper(spark, d, "nation", "customer", "orders")
    some = closure.upclosure(frames, _sampling_specs(), {"ORDERS": frames["ORDERS"].where("O_ORDERPRIORITY = '1-URGENT'")}, Scratch(spark, "up"))
    return stats.counts(some)


@query
def frontier_instruments(spark, d):
    """What each instrument reaches in up to four steps along pertence."""
    (i,) = _t(spark, d, "instrumento_financeiro")
    edges = i.where("num_if_pertence is not null").select(F.col("num_if").alias("id"), F.col("num_if_pertence").alias("next")).distinct()
    start = edges.select(F.col("id").alias("root"), "id")
    return closure.frontier(start, edges, 4, Scratch(spark, "frontier")).select(F.col("root").alias("num_if"), F.col("id").alias("alcancado"), F.col("hop").alias("passo"))


# --- clones, shifts and dates -------------------------------------------------------------------------------------------


def _order_map(spark, d):
    (o,) = _t(spark, d, "orders")
    top = o.agg(F.max("o_orderkey")).first()[0]
    return o, Scratch(spark, "clone"), clone.key_map(o, "o_orderkey"), clone.next_start(top, band=1000)


@query
def clone_orders_k3(spark, d):
    o, scratch, m, start = _order_map(spark, d)
    return clone.clone_root(o, "o_orderkey", m, 3, start, scratch).select("o_orderkey", "o_custkey", "o_totalprice", F.col(clone.K).alias("k"))


@query
def clone_map_orders(spark, d):
    _, _, m, start = _order_map(spark, d)
    return clone.expand_map(m, 3, start)


@query
def clone_lineitem_fk_remap(spark, d):
    _, scratch, m, start = _order_map(spark, d)
    (li,) = _t(spark, d, "lineitem")
    out = clone.remap(clone.multiply(li.select("l_orderkey", "l_linenumber", "l_quantity"), 3), "l_orderkey", m, 3, start, scratch, ["l_linenumber", "l_quantity"])
    return out.withColumnRenamed(clone.K, "k")


@query
def clone_validation_report(spark, d):
    o, scratch, m, start = _order_map(spark, d)
    return checks.clone_report(o, clone.clone_root(o, "o_orderkey", m, 3, start, scratch), "o_orderkey", 3, start, ["o_orderkey", "o_custkey"])


@query
def clone_guard_new(spark, d):
    """Instruments that the titles don't have yet, as an append would see them."""
    i, t = _t(spark, d, "instrumento_financeiro", "titulo")
    return clone.guard_new(i.select("num_if", "num_tipo_if").distinct(), t, "num_if")


@query
def shift_keys_orders(spark, d):
    specs = catalog.normalise({"ORDERS": {"pk_cols": ["o_orderkey"], "fks": [{"columns": ["o_custkey"], "parent_table": "CUSTOMER", "parent_columns": ["c_custkey"]}]}, "CUSTOMER": {"pk_cols": ["c_custkey"], "static": True}})
    (o,) = _t(spark, d, "orders")
    return clone.shift(o, [c.lower() for c in catalog.shift_columns(specs, "ORDERS")], 1_000_000).select("o_orderkey", "o_custkey")


@query
def null_out_columns(spark, d):
    (t,) = _t(spark, d, "titulo")
    return clone.null_out(t, ["num_conta_participante", "num_if"], {"num_if"}).select("num_if", "num_conta_participante", "num_carga")


@query
def dates_preserve_term(spark, d):
    (t,) = _t(spark, d, "titulo")
    return dates.preserve_term(t, "dat_emissao", "dat_vencimento", TODAY).select("num_if", F.col("dat_emissao").cast("date").alias("dat_emissao"), F.col("dat_vencimento").cast("date").alias("dat_vencimento"))


@query
def dates_delta_shift_children(spark, d):
    o, li = _t(spark, d, "orders", "lineitem")
    moved = dates.shifts(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey", "o_orderdate", TODAY)
    out = dates.shift_children(li.select("l_orderkey", "l_linenumber", "l_shipdate"), "l_orderkey", ["l_shipdate"], moved, Scratch(spark, "dates"), ["l_linenumber"])
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


# --- ordinals and codes -------------------------------------------------------------------------------------------------


@query
def ordinal_dense_events(spark, d):
    (e,) = _t(spark, d, "events")
    return prefix.ordinal(e.select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "ordinal")


@query
def ordinal_running_sum(spark, d):
    """The value of a type's events before each event, in the order of its hash: no type goes to one task."""
    (e,) = _t(spark, d, "events")
    h = F.conv(F.substring(F.sha2(F.col("event_id").cast("string"), 256), 1, 13), 16, 10).cast("bigint")
    out = prefix.running(e.select("event_id", "event_type", h.alias("h")), ["event_type"], "h", ["event_id"], F.lit(1), F.lit(64), Scratch(spark, "running"), "antes")
    return out.select("event_id", "event_type", "antes")


@query
def code_placeholder_base36(spark, d):
    (o,) = _t(spark, d, "orders")
    n = prefix.ordinal(o.select("o_orderkey"), ["o_orderkey"])
    return n.select("o_orderkey", clone.placeholder(F.col("ordinal"), "CDB9").alias("codigo"), clone.operation_code(F.col("ordinal")).alias("codigo_operacao"))


@query
def control_numbers_two_sided(spark, d):
    (o,) = _t(spark, d, "operacao")
    one = o.groupBy("num_id_operacao").agg(F.min("num_conta_participante_p1").alias("p1"), F.min("num_conta_participante_p2").alias("p2"))
    return clone.control_numbers(one, "num_id_operacao", "p1", "p2", "100")


@query
def propagate_root_code(spark, d):
    o, i = _t(spark, d, "operacao", "instrumento_financeiro")
    return clone.propagate(o.select("num_id_operacao", "num_if", "cod_if"), i, "num_if", "cod_if", Scratch(spark, "propagate"), ["num_id_operacao"])


@query
def control_tuples_met(spark, d):
    a, b = _t(spark, d, "operacao", "contexto_mensagem")
    x = a.select(F.col("num_conta_participante_p1").alias("conta"), F.to_date("dat_inclusao").alias("dia"))
    y = b.select(F.col("num_conta_participante").alias("conta"), F.to_date("dat_inclusao").alias("dia"))
    return clone.tuples_met(x, y, ["conta", "dia"]).groupBy("dia").agg(F.count(F.lit(1)).alias("contas"))


# --- selection and domains ------------------------------------------------------------------------------------------------


@query
def select_hash_page(spark, d):
    return selection.page(*_t(spark, d, "instrumento_financeiro"), "num_if", "s1", 100)


@query
def keyset_page(spark, d):
    """The second page, from the first one's end."""
    (i,) = _t(spark, d, "instrumento_financeiro")
    last = selection.page(i, "num_if", "s1", 100).orderBy(F.desc("posto")).first()
    return selection.page(i, "num_if", "s1", 100, (last["posto"], last["num_if"]))


@query
def select_admitted(spark, d):
    """A hundred instruments whose title exists, refilled page by page."""
    i, t = _t(spark, d, "instrumento_financeiro", "titulo")
    return selection.choose(i, "num_if", 100, "s1", lambda k: k.join(t.select("num_if"), "num_if", "left_anti"), Scratch(spark, "choose"))


CATALOGUE = """
-- BEGIN QUERY: com_titulo_e_operacao
-- Instruments with an active title and an operation that is not excluded.
SELECT DISTINCT i.num_if
FROM {{RAW_INSTRUMENTO_FINANCEIRO}} i
  JOIN {{RAW_TITULO}} t ON t.num_if = i.num_if
  JOIN {{RAW_OPERACAO}} o ON o.num_if = i.num_if
WHERE o.dat_exclusao IS NULL AND coalesce(trim(i.dat_exclusao), '') = '';
-- END QUERY: com_titulo_e_operacao
"""


@query
def domain_sql_catalogue(spark, d):
    sql = catalogue.section(CATALOGUE, "com_titulo_e_operacao")
    names = ("instrumento_financeiro", "titulo", "operacao")
    return catalogue.keys_only(catalogue.run(spark, sql, dict(zip(names, _t(spark, d, *names)))), "num_if")


@query
def domain_exists_query(spark, d):
    i, t, o = _t(spark, d, "instrumento_financeiro", "titulo", "operacao")
    return selection.domain(keys.active_declared(i, "dat_exclusao"), "num_if", [t, keys.active_null(o, "dat_exclusao")])


@query
def domain_minus_exclusions(spark, d):
    i, t, o = _t(spark, d, "instrumento_financeiro", "titulo", "operacao")
    return selection.domain(i, "num_if", [t], [o, i.where("num_if_pertence is not null")])


@query
def faltantes_missing_keys(spark, d):
    c, x, e, o, m = _t(spark, d, "carteira_comitente", "conta", "comitente", "operacao", "contexto_mensagem")
    return (
        selection.missing_keys(c, "num_conta", x, "num_conta", "carteira_comitente")
        .unionByName(selection.missing_keys(c, "num_id_entidade", e, "num_id_entidade", "carteira_comitente"))
        .unionByName(selection.missing_keys(o, "num_id_ctx_msg_p2", m, "num_id_ctx_msg", "operacao"))
    )


@query
def faltantes_merge(spark, d):
    """Yesterday's list with one of its columns enumerated anew."""
    c, x, e = _t(spark, d, "carteira_comitente", "conta", "comitente")
    old = selection.missing_keys(c, "num_conta", x, "num_conta", "carteira_comitente").unionByName(selection.missing_keys(c, "num_id_entidade", e.where("dat_exclusao is null"), "num_id_entidade", "carteira_comitente"))
    return selection.merge_missing(old, selection.missing_keys(c, "num_id_entidade", e, "num_id_entidade", "carteira_comitente"), [("carteira_comitente", "num_id_entidade")])


@query
def faltantes_drift(spark, d):
    """The list of missing keys kept in a folder: written, one of its columns enumerated anew, merged, and put back in its own place."""
    c, x, e = _t(spark, d, "carteira_comitente", "conta", "comitente")
    path = f"{Scratch(spark, 'faltantes').at}/lista"
    publish.replace_table(selection.missing_keys(c, "num_conta", x, "num_conta", "carteira_comitente").unionByName(selection.missing_keys(c, "num_id_entidade", e.where("dat_exclusao is null"), "num_id_entidade", "carteira_comitente")), path)
    new = selection.missing_keys(c, "num_id_entidade", e, "num_id_entidade", "carteira_comitente")
    publish.replace_table(selection.merge_missing(spark.read.parquet(path), new, [("carteira_comitente", "num_id_entidade")]), path)
    return spark.read.parquet(path)


@query
def admission_rejected(spark, d):
    """Instruments with a holding whose account is neither in their own batch nor at the target."""
    c, x, own = _t(spark, d, "carteira_comitente", "conta_destino", "conta")
    prov = c.select(F.col("num_if").alias("__root")).distinct()
    child = c.select(F.col("num_if").alias("__root"), keys.norm_key(F.col("num_conta")).alias("key"))
    new = own.where("num_id_situacao_conta = 2").select(keys.norm_key(F.col("num_conta")).alias("key")).distinct()
    batch = child.join(new, "key", "left_semi").select("__root", "key")
    target = x.select(keys.norm_key(F.col("num_conta")).alias("key"))
    return selection.rejected(prov, {"num_conta": (child, batch, target)}).select(F.col("__root").alias("num_if"), "fk")


SALES = {
    "REGION": {"pk_cols": ["R_REGIONKEY"], "static": True},
    "NATION": {"pk_cols": ["N_NATIONKEY"], "static": True, "fks": [{"columns": ["N_REGIONKEY"], "parent_table": "REGION", "parent_columns": ["R_REGIONKEY"]}]},
    "CUSTOMER": {"pk_cols": ["C_CUSTKEY"], "fks": [{"columns": ["C_NATIONKEY"], "parent_table": "NATION", "parent_columns": ["N_NATIONKEY"]}]},
    "ORDERS": {"pk_cols": ["O_ORDERKEY"], "fks": [{"columns": ["C_CUSTKEY"], "parent_table": "CUSTOMER", "parent_columns": ["C_CUSTKEY"]}]},
    "PART": {"pk_cols": ["P_PARTKEY"], "static": True},
    "SUPPLIER": {"pk_cols": ["S_SUPPKEY"], "static": True, "fks": [{"columns": ["S_NATIONKEY"], "parent_table": "NATION", "parent_columns": ["N_NATIONKEY"]}]},
    "LINEITEM": {
        "pk_cols": ["O_ORDERKEY", "L_LINENUMBER"],
        "fks": [
            {"columns": ["O_ORDERKEY"], "parent_table": "ORDERS", "parent_columns": ["O_ORDERKEY"]},
            {"columns": ["L_PARTKEY"], "parent_table": "PART", "parent_columns": ["P_PARTKEY"]},
            {"columns": ["L_SUPPKEY"], "parent_table": "SUPPLIER", "parent_columns": ["S_SUPPKEY"]},
        ],
    },
}


@query
def admission_refilled(spark, d):
    """Thirty customers all of whose orders and items resolve at a target that lacks some parts; rejected ones are refilled."""
    c, o, li, n, p, s = _t(spark, d, "customer", "orders", "lineitem", "nation", "part", "supplier")
    specs = catalog.normalise(SALES)
    plans = catalog.clone_plans({t: specs[t] for t in ("CUSTOMER", "ORDERS", "LINEITEM")}, "CUSTOMER", {"CUSTOMER": {"C_CUSTKEY"}, "ORDERS": {"O_ORDERKEY"}})
    frames = {"CUSTOMER": c, "ORDERS": o.withColumnRenamed("o_custkey", "c_custkey"), "LINEITEM": li.withColumnRenamed("l_orderkey", "o_orderkey")}
    scratch = Scratch(spark, "admission")
    reject = selection.admission(frames, plans, specs, "CUSTOMER", {"NATION": n, "PART": p.where("p_size <> 7"), "SUPPLIER": s}, scratch)
    return selection.choose(c.select("c_custkey"), "c_custkey", 30, "s1", reject, scratch)


@query
def source_filters_instrumento(spark, d):
    (i,) = _t(spark, d, "instrumento_financeiro")
    out, notes = selection.source_filters(i, {"num_tipo_if": 49, "coluna_que_falta": 1}, {"num_carga": 5}, ("num_if_origem",))
    return out.select("num_if", "num_carga").distinct().withColumn("avisos", F.lit(len(notes)))


@query
def bernoulli_by_hash(spark, d):
    return selection.bernoulli(*_t(spark, d, "events"), "event_id", 0.05, "s1").select("event_id", "event_type")


@query
def plan_load_order(spark, d):
    """The load order of the sales tables, with the rows that each then brings."""
    order = catalog.load_order(["LINEITEM", "ORDERS", "CUSTOMER", "NATION", "REGION", "PART", "SUPPLIER"], catalog.normalise(SALES))
    n = stats.counts({t: table(spark, d, t.lower()) for t in order})
    return spark.createDataFrame([(i, t) for i, t in enumerate(order, 1)], "posicao int, tabela string").join(n, "tabela").select("posicao", "tabela", "n")


@query
def plan_buckets(spark, d):
    """Tables dealt by their rows to three loads, the largest first to the lightest: the loads that come out, largest first."""
    names = ("customer", "orders", "lineitem", "part", "supplier", "nation", "region")
    size = {r["tabela"]: r["n"] for r in stats.counts({t: table(spark, d, t) for t in names}).collect()}
    return spark.createDataFrame([(sum(size[t] for t in b), ",".join(sorted(b))) for b in catalog.pack_by_size(size, 3)], "linhas bigint, tabelas string")


@query
def partitioned_pruned(spark, d):
    """Orders written in a folder a status and priority; two identities read back, no other folder with them."""
    (o,) = _t(spark, d, "orders")
    path, by = f"{Scratch(spark, 'particoes').at}/saida", ["o_orderstatus", "o_orderpriority"]
    publish.write_partitioned(o, path, by)
    back = spark.read.parquet(path).where(publish.identities(by, [("O", "1-URGENT"), ("F", "2-HIGH")]))
    return back.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("soma_chaves"))


@query
def run_directory_latest(spark, d):
    """Two runs published one after the other: what the pointer names, as its tables read back."""
    n, r = _t(spark, d, "nation", "region")
    base = f"{Scratch(spark, 'execucoes').at}/saida"
    publish.run_directory(spark, base, "r1", {"region": r})
    publish.run_directory(spark, base, "r2", {"region": r, "nation": n})
    now = publish.latest(spark, base)
    return stats.counts({t: spark.read.parquet(f"{base}/{now['run']}/{t}") for t in now["rows"]}).withColumn("execucao", F.lit(now["run"]))


# --- shapes ---------------------------------------------------------------------------------------------------------------


def _shapes(spark, d):
    c, o, li = _t(spark, d, "customer", "orders", "lineitem")
    lines = li.select("l_orderkey").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    metrics = [shape.Metric("pedidos", o, "o_custkey"), shape.Metric("abertos", o.where("o_orderstatus = 'O'"), "o_custkey"), shape.Metric("linhas", lines, "o_custkey"), shape.Metric("devolucoes", None, "o_custkey")]
    return shape.counts(c, "c_custkey", metrics)[0], [m.name for m in metrics]


@query
def shape_counts_per_customer(spark, d):
    return _shapes(spark, d)[0].withColumn("assinatura", shape.signature(["pedidos", "abertos", "devolucoes"]))


@query
def shape_distribution(spark, d):
    return shape.distribution(_shapes(spark, d)[0], "c_custkey", ["pedidos", "abertos"])


@query
def shape_marginals(spark, d):
    c, names = _shapes(spark, d)
    return shape.marginals(c, names)


@query
def shape_reference_match(spark, d):
    return shape.reference_match(_shapes(spark, d)[0], {"pedidos": 10, "abertos": 5})


def _operation_shapes(spark, d, side):
    i, o, c = _t(spark, d, "instrumento_financeiro", "operacao", "carteira_comitente")
    uni = i.where(f"num_tipo_if = {side}")
    metrics = [shape.Metric("operacoes", o, "num_if"), shape.Metric("carteiras", c, "num_if")]
    return shape.distribution(shape.counts(uni, "num_if", metrics)[0], "num_if", ["operacoes", "carteiras"])


@query
def shape_compare_status(spark, d):
    """Shapes of two kinds of instruments against each other."""
    return shape.compare(_operation_shapes(spark, d, 49), _operation_shapes(spark, d, 50)).withColumns({c: F.round(c, 9) for c in ("parte_aqui", "parte_la", "deriva")})


@query
def shape_total_variation(spark, d):
    return shape.total_variation(shape.compare(_operation_shapes(spark, d, 49), _operation_shapes(spark, d, 50))).withColumn("distancia", F.round("distancia", 9))


@query
def attribute_top_values(spark, d):
    return shape.top_values(*_t(spark, d, "operacao"), "num_conta_participante_p1", 50)


@query
def universe_fingerprint(spark, d):
    return shape.fingerprint(*_t(spark, d, "instrumento_financeiro"), "num_if")


# --- similarity -----------------------------------------------------------------------------------------------------------


def _columns(spark, d):
    names = ("comitente", "comitente_destino", "conta", "conta_destino", "titulo", "instrumento_financeiro")
    frames = dict(zip(names, _t(spark, d, *names)))
    values = Scratch(spark, "similarity").keep(similarity.value_counts(frames, similarity.plans(frames, {"titulo": {"num_if", "num_carga"}, "instrumento_financeiro": {"num_if", "num_carga"}})))
    return values, similarity.profiles(values)


@query
def column_profile(spark, d):
    return _columns(spark, d)[1]


@query
def column_candidate_pairs(spark, d):
    return similarity.pairs(_columns(spark, d)[1]).select(*similarity.PAIR, "situacao")


@query
def jaccard_exact(spark, d):
    v, p = _columns(spark, d)
    return similarity.jaccard(v, similarity.pairs(p))


@query
def jaccard_bottomk_wilson(spark, d):
    """The sketch on every pair, large or small."""
    v, p = _columns(spark, d)
    return similarity.sketch_jaccard(v, similarity.pairs(p), over=0)


def _psi(spark, d):
    v, p = _columns(spark, d)
    scratch = Scratch(spark, "psi")
    r = scratch.keep(similarity.ranked(v, p, scratch))
    return p, r, similarity.cuts(r, spark)


@query
def psi_edges_nearest_rank(spark, d):
    return _psi(spark, d)[2].select("tipo", F.posexplode("cortes").alias("ordem", "corte"))


@query
def psi_bins_grid(spark, d):
    _, r, c = _psi(spark, d)
    return similarity.binned(r, c).drop("tipo")


@query
def psi_scores(spark, d):
    p, r, c = _psi(spark, d)
    return similarity.psi(similarity.binned(r, c), similarity.pairs(p)).withColumn("psi", F.round("psi", 9))


@query
def similarity_integrity(spark, d):
    p, r, c = _psi(spark, d)
    return similarity.integrity(p, similarity.binned(r, c))


# --- statistics, sets and windows -------------------------------------------------------------------------------------------


@query
def stats_summary(spark, d):
    out = stats.summary(*_t(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.withColumns({c: F.round(c, 6) for c in ("media", "desvio")})


@query
def stats_percentiles(spark, d):
    return stats.summary(*_t(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"], (0.25, 0.5, 0.75))


@query
def stats_percentiles_ranks(spark, d):
    """Whether each approximate percentile's exact rank lies within the accuracy of one in 10,000 rows."""
    (li,) = _t(spark, d, "lineitem")
    shares, cols = (0.25, 0.5, 0.75), ["l_quantity", "l_extendedprice"]
    got = stats.summary(li, cols, shares)
    each = got.select("coluna", "n", F.explode(F.array(*(F.struct(F.lit(q).alias("parte"), F.col(f"`p{q:g}`").alias("v")) for q in shares))).alias("e")).select("coluna", "n", "e.parte", "e.v")
    values = li.select(F.explode(F.array(*(F.struct(F.lit(c).alias("coluna"), F.col(c).cast("double").alias("x")) for c in cols))).alias("e")).select("e.coluna", "e.x")
    ranks = values.join(F.broadcast(each), "coluna").groupBy("coluna", "parte", "n").agg(F.count_if(F.col("x") < F.col("v")).alias("abaixo"), F.count_if(F.col("x") <= F.col("v")).alias("ate"))  # a row a column and share
    off = F.col("n") / 10_000 + 1
    return ranks.select("coluna", "parte", "n", ((F.col("abaixo") - off <= F.col("parte") * F.col("n")) & (F.col("parte") * F.col("n") <= F.col("ate") + off)).alias("dentro"))


@query
def stats_null_rates(spark, d):
    return stats.null_rates(*_t(spark, d, "operacao"))


@query
def histogram_fixed_bins(spark, d):
    return stats.histogram(*_t(spark, d, "lineitem"), "l_quantity", 0.0, 50.0, 20)


@query
def range_coverage(spark, d):
    c, s = _t(spark, d, "customer", "supplier")
    return stats.coverage(c.select(F.col("c_acctbal").alias("saldo"), F.col("c_nationkey").alias("nacao")), s.select(F.col("s_acctbal").alias("saldo"), F.col("s_nationkey").alias("nacao")), ["saldo", "nacao"])


@query
def table_counts_one_action(spark, d):
    names = ("customer", "orders", "lineitem", "operacao", "documents")
    return stats.counts(dict(zip(names, _t(spark, d, *names))))


@query
def union_by_name(spark, d):
    c, s = _t(spark, d, "customer", "supplier")
    return c.select(F.col("c_name").alias("nome"), F.col("c_nationkey").alias("nacao")).unionByName(s.select(F.col("s_nationkey").alias("nacao"), F.col("s_name").alias("nome")))


@query
def set_difference_anti(spark, d):
    i, t = _t(spark, d, "instrumento_financeiro", "titulo")
    return i.select("num_if").distinct().join(t.select("num_if"), "num_if", "left_anti")


@query
def intersect_semi(spark, d):
    c, s = _t(spark, d, "customer", "supplier")
    return c.select(F.col("c_nationkey").alias("nacao")).distinct().join(s.select(F.col("s_nationkey").alias("nacao")), "nacao", "left_semi")


@query
def rank_bottomk_by_hash(spark, d):
    """The ten customers of least hash in each segment: the limit is taken before the shuffle."""
    (c,) = _t(spark, d, "customer")
    w = Window.partitionBy("c_mktsegment").orderBy("h", "c_custkey")
    return c.select("c_mktsegment", "c_custkey", F.sha2(F.col("c_custkey").cast("string"), 256).alias("h")).withColumn("posto", F.row_number().over(w)).where("posto <= 10")


# --- publication ------------------------------------------------------------------------------------------------------------


@query
def publish_readback_counts(spark, d):
    n, r = _t(spark, d, "nation", "customer")
    base = f"{Scratch(spark, 'publicado').at}/saida"
    counts = publish.publish(spark, {"nation": n, "customer": r}, base, [d])
    back = {t: spark.read.parquet(f"{base}/{t}") for t in counts}
    return stats.counts(back)


@query
def snapshot_roundtrip(spark, d):
    (o,) = _t(spark, d, "orders")
    path = f"{Scratch(spark, 'retrato').at}/saida"
    publish.write_checked(o, path, publish.snapshot_partitions(o.count()))
    return repair.frame_differences(o, spark.read.parquet(path), ["o_orderkey"])


@query
def reservation_ranges(spark, d):
    """Key ranges reserved for two batches of three clones of every order and customer, each beyond the last and beyond what is there."""
    o, c = _t(spark, d, "orders", "customer")
    n = {r["tabela"]: r["n"] for r in stats.counts({"orders": o, "customer": c}).collect()}
    floors = {"orders": o.agg(F.max("o_orderkey")).first()[0], "customer": c.agg(F.max("c_custkey")).first()[0]}
    ledger = publish.reserve([], {k: 3 * v for k, v in n.items()}, floors)
    ledger = publish.reserve(ledger, {k: 3 * v for k, v in n.items()}, floors)
    path = publish.artefact(spark, Scratch(spark, "reservas").at, "reserva", {"faixas": ledger})
    rows = publish.read_artefact(spark, path)["faixas"]
    return spark.createDataFrame([(r["name"], r["start"], r["end"]) for r in rows], "nome string, inicio bigint, fim bigint")


# --- before and after a load ------------------------------------------------------------------------------------------------


@query
def preflight_operacao(spark, d):
    """A load of operations checked against what its target holds and allows."""
    o, i = _t(spark, d, "operacao", "instrumento_financeiro")
    T = preflight.Target
    target = {"num_id_operacao": T(None, 10, 0, False), "num_if": T(None, 9, 0, True), "cod_if": T(10), "cod_operacao": T(16), "num_id_ctx_msg_p2": T(12), "num_carga": T(None, 2, 0), "dat_operacao": T(nullable=False)}
    return preflight.preflight(o, "operacao", target, [["num_id_operacao"], ["cod_if", "cod_operacao"]], {"num_id_operacao": o.select("num_id_operacao")}, {("num_if",): (i, ("num_if",))})


@query
def business_key_rules(spark, d):
    i, o = _t(spark, d, "instrumento_financeiro", "operacao")
    return preflight.business_keys(i, "num_if", "cod_if", "^[A-Z]{3}[0-9A-Z]{8}$", o, "cod_if", ["num_conta_participante_p1", "num_id_ctx_msg_p2"])


@query
def roots_without_child(spark, d):
    i, t = _t(spark, d, "instrumento_financeiro", "titulo")
    return preflight.without_child(i, "num_if", t.where("cod_tipo_escalonamento is not null"))


@query
def shift_overflow(spark, d):
    o, c, i = _t(spark, d, "orders", "customer", "instrumento_financeiro")
    return preflight.shift_report({"orders": (o, "o_orderkey"), "customer": (c, "c_custkey"), "instrumento_financeiro": (i, "num_if")}, 10_000, {"orders": 20_000})


@query
def code_map_consistency(spark, d):
    (o,) = _t(spark, d, "orders")
    m = prefix.ordinal(o.select("o_orderkey"), ["o_orderkey"]).select("o_orderkey", "ordinal", clone.placeholder(F.col("ordinal"), "CDB9").alias("codigo"))
    return preflight.ordinal_consistency(m, "ordinal", "o_orderkey", "codigo", "^CDB9[0-9A-Z]{5}$", 1)


@query
def load_marks(spark, d):
    o, c, e = _t(spark, d, "orders", "customer", "events")
    return preflight.load_marks({"orders": (o, "o_orderkey"), "customer": (c, "c_custkey"), "events": (e.where("false"), "event_id")})


@query
def load_rolled_back(spark, d):
    """Orders appended behind their highest key, and taken away again by the mark from before."""
    o, scratch, m, start = _order_map(spark, d)
    mark = preflight.load_marks({"orders": (o, "o_orderkey")}).first()["maximo"]
    after = o.unionByName(clone.clone_root(o, "o_orderkey", m, 1, start, scratch).drop(clone.K))
    return preflight.roll_back(after, "o_orderkey", mark).select("o_orderkey", "o_custkey")


@query
def clone_key_sample(spark, d):
    """The first old keys with the keys of their clones: a report."""
    _, _, m, start = _order_map(spark, d)
    return clone.expand_map(m, 3, start).orderBy("old", "k").limit(20)


@query
def explain_missing_key(spark, d):
    """An account that holdings name and the accounts lack, followed through every stage."""
    c, x = _t(spark, d, "carteira_comitente", "conta")
    lost = selection.missing_keys(c, "num_conta", x, "num_conta", "carteira_comitente")
    key = lost.agg(F.min("VALOR")).first()[0] or ""
    return preflight.explain_key(key, {"carteira": (c, "num_conta"), "carteira_ativa": (keys.active_null(c, "dat_exclusao"), "num_conta"), "conta": (x, "num_conta"), "faltantes": (lost, "VALOR")}, keys.norm_key)


@query
def observed_discriminators(spark, d):
    """The kinds of instruments that come with each redemption schedule flag, and their codes' prefixes."""
    (i,) = _t(spark, d, "instrumento_financeiro")
    p = F.upper(F.substring(F.trim("cod_if"), 1, 3))
    return i.where(F.coalesce(F.trim("cod_if"), F.lit("")) != "").groupBy("num_tipo_if").agg(F.concat_ws(",", F.sort_array(F.collect_set(p))).alias("prefixos"))  # as many as there are kinds


@query
def segment_flags(spark, d):
    """Whether any holder of an instrument is a simplified one: sim, nao, or sem_carteira."""
    i, c, e = _t(spark, d, "instrumento_financeiro", "carteira_comitente", "comitente")
    flag = e.groupBy("num_id_entidade").agg(F.max(F.when(F.col("ind_comitente_simplificado") == "S", 1).otherwise(0)).alias("s"))
    held = salted_join(c.select("num_if", "num_id_entidade", "num_carteira_comitente"), flag, ["num_id_entidade"], "left", ["num_carteira_comitente"])
    per = held.groupBy("num_if").agg(F.max("s").alias("s"))
    return i.select("num_if").distinct().join(per.withColumn("__c", F.lit(True)), "num_if", "left").select("num_if", F.when(F.col("__c").isNull(), "sem_carteira").when(F.col("s") == 1, "sim").when(F.col("s") == 0, "nao").otherwise("desconhecido").alias("segmento"))
