"""SQL for DuckDB of the general relational queries, written independently of the operators."""

from __future__ import annotations

from .problems_sql import num

SQL: dict[str, str] = {}
TODAY = "date '2026-06-30'"


def _u(parts) -> str:
    return " union all ".join(f"({p})" for p in parts)


def _find(t, kind, cols, sql) -> str:
    return f"select '{t}' as tabela, '{kind}' as verificacao, '{cols}' as colunas, ({sql}) as violacoes"


def _nn(t, cols):
    return _u(_find(t, "not_null", c, f"select count(*) from {t} where {c} is null") for c in cols)


INSTR = ["num_if", "num_tipo_if", "cod_if", "num_if_origem", "num_if_pertence", "dat_emissao", "dat_vencimento", "dat_registro", "dat_exclusao", "ind_agenda_constante", "num_carga"]
SQL["chk_not_null_events"] = _nn("events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
SQL["chk_not_null_instrumento"] = _nn("instrumento_financeiro", INSTR)
SQL["chk_decimal_domain_lineitem"] = _u(_find("lineitem", "decimal_domain", c, f"select count(*) from lineitem where abs({c}) >= {n}") for c, n in (("l_extendedprice", 10000), ("l_quantity", 10), ("l_discount", 1)))
SQL["chk_varchar_domain_part"] = _u(_find("part", "varchar_domain", c, f"select count(*) from part where length({c}) > {n}") for c, n in (("p_name", 10), ("p_brand", 7), ("p_type", 8)))


def _dup(t, cols, where="true"):
    return f"select count(*) from (select {cols} from {t} where {where} group by {cols} having count(*) > 1)"


SQL["chk_pk_unique_lineitem"] = _find("lineitem", "pk_unique", "l_orderkey,l_linenumber", _dup("lineitem", "l_orderkey, l_linenumber"))
SQL["chk_pk_unique_contexto"] = _find("contexto_mensagem", "pk_unique", "num_id_ctx_msg", _dup("contexto_mensagem", "num_id_ctx_msg"))
SQL["chk_pk_collision_instrumento_titulo"] = _find("instrumento_financeiro", "pk_collision", "num_if", "select count(*) from (select num_if from instrumento_financeiro where num_if is not null intersect select num_if from titulo)")


def _fk(c, col, up):
    return f"select count(*) from (select distinct {col} k from {c} where {col} is not null) where k not in ({up})"


SQL["chk_fk_lineitem_orders"] = _find("lineitem", "fk", "l_orderkey", _fk("lineitem", "l_orderkey", "select o_orderkey from orders"))
SQL["chk_fk_titulo_instrumento"] = _u([_find("titulo", "fk", "num_if", _fk("titulo", "num_if", "select num_if from instrumento_financeiro where num_if is not null")), _find("titulo", "fk_linhas", "num_if", "select count(*) from titulo where num_if is not null and num_if not in (select num_if from instrumento_financeiro where num_if is not null)")])
SQL["chk_fk_orders_customer_union_parents"] = _find("orders", "fk", "o_custkey", _fk("orders", "o_custkey", "select c_custkey from customer union all select s_suppkey from supplier"))
SQL["chk_unique_customer_name"] = _find("customer", "unique", "c_name", _dup("customer", "c_name", "c_name is not null"))
SQL["chk_unique_instrumento_cod_if"] = _find("instrumento_financeiro", "unique", "cod_if", _dup("instrumento_financeiro", "cod_if", "cod_if is not null"))
SQL["chk_profile_one_pass_orders"] = _u(
    [
        *(f"select '{c}' as coluna, count(*) as total, count(*) - count({c}) as nulos, cast(min({c}) as varchar) as minimo, cast(max({c}) as varchar) as maximo, max(octet_length(encode(cast({c} as varchar)))) as octetos, null as distintos from orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")),
        "select 'o_custkey', count(*), count(*) - count(o_custkey), null, null, null, count(distinct o_custkey) from orders",
        "select 'o_custkey+o_orderstatus', count(*), count(*) filter (o_custkey is null or o_orderstatus is null), null, null, null, (select count(*) from (select distinct o_custkey, o_orderstatus from orders where o_custkey is not null and o_orderstatus is not null)) from orders",
    ]
)
SQL["chk_octet_length_documents"] = "select lang, max(strlen(text)) as octetos, max(length(text)) as caracteres, count(*) filter (strlen(text) > 4000) as acima_4000 from documents group by 1"
SQL["chk_validate_all"] = _u(
    [
        _find("CUSTOMER", "not_null", "C_CUSTKEY", "select count(*) from customer where c_custkey is null"),
        _find("CUSTOMER", "pk_unique", "C_CUSTKEY", _dup("customer", "c_custkey")),
        _find("CUSTOMER", "fk", "C_NATIONKEY", _fk("customer", "c_nationkey", "select n_nationkey from nation")),
        _find("ORDERS", "not_null", "O_ORDERKEY", "select count(*) from orders where o_orderkey is null"),
        _find("ORDERS", "decimal_domain", "O_ORDERKEY", "select count(*) from orders where abs(o_orderkey) >= 1000000000"),
        _find("ORDERS", "varchar_domain", "O_ORDERPRIORITY", "select count(*) from orders where length(o_orderpriority) > 8"),
        _find("ORDERS", "pk_unique", "O_ORDERKEY", _dup("orders", "o_orderkey")),
        _find("ORDERS", "unique", "O_CUSTKEY", _dup("orders", "o_custkey", "o_custkey is not null")),
        _find("ORDERS", "fk", "O_CUSTKEY", _fk("orders", "o_custkey", "select c_custkey from customer")),
        *(_find("LINEITEM", "not_null", c, f"select count(*) from lineitem where {c} is null") for c in ("L_LINENUMBER", "L_ORDERKEY")),
        _find("LINEITEM", "pk_unique", "L_ORDERKEY,L_LINENUMBER", _dup("lineitem", "l_orderkey, l_linenumber")),
        _find("LINEITEM", "fk", "L_ORDERKEY", _fk("lineitem", "l_orderkey", "select o_orderkey from orders")),
        "select 'LINEITEM', 'fk', 'L_PARTKEY', null",
        _find("NATION", "not_null", "N_NATIONKEY", "select count(*) from nation where n_nationkey is null"),
        _find("NATION", "pk_unique", "N_NATIONKEY", _dup("nation", "n_nationkey")),
    ]
)
BLANK = "coalesce(trim(dat_exclusao), '') = ''"
SQL["chk_classify_orphans"] = f"select num_if, case when num_if in (select num_if from instrumento_financeiro where num_if is not null) then 'processo' else 'producao' end as origem from (select distinct num_if from titulo where num_if is not null and num_if not in (select num_if from instrumento_financeiro where num_if is not null and {BLANK}))"
SQL["chk_two_paths"] = "select distinct num_id_operacao, o.num_if, upper(trim(o.cod_if)) as proprio, codigo from operacao o join (select num_if, min(upper(trim(cod_if))) as codigo from instrumento_financeiro group by 1) i on i.num_if = o.num_if where upper(trim(o.cod_if)) is distinct from codigo"
SQL["chk_active_variants"] = _u([f"select 'declarada' as tabela, count(*) as n from instrumento_financeiro where {BLANK}", f"select 'primeira', count(*) from instrumento_financeiro where {BLANK}", "select 'nula', count(*) from instrumento_financeiro where dat_exclusao is null", "select 'sinalizada', count(*) from conta where coalesce(trim(ind_excluido), '') not in ('S', 'Y', '1')"])
NORM = "regexp_replace(trim({c}), '\\.0+$', '')"
SQL["key_forms"] = f"""select distinct num_conta, {NORM.format(c='num_conta')} as norm_key, regexp_replace(trim(num_conta), '\\.0$', '') as norm_code,
case when regexp_full_match(trim(num_conta), '[+-]?[0-9]+\\.[0-9]*') then rtrim(rtrim(trim(num_conta), '0'), '.') else trim(num_conta) end as canon_key, num_conta as fk_text from carteira_comitente"""

SQL["join_inner_collision"] = "select distinct num_if from instrumento_financeiro where num_if in (select num_if from titulo)"
SQL["join_anti_orders_without_lineitem"] = "select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem)"
SQL["join_semi_customers_with_orders"] = "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders)"
SQL["join_left_coalesce_remap"] = f"select k as num_carteira_comitente, coalesce(x.codigo, trim(c.num_conta)) as conta from (select distinct num_carteira_comitente k, num_conta from carteira_comitente) c left join (select num_conta, min(cod_conta) codigo from conta group by 1) x on x.num_conta = try_cast({NORM.format(c='c.num_conta')} as bigint)"
SQL["join_cross_k"] = "select n_nationkey, n_name, k from nation cross join range(1, 5) r(k)"
SQL["join_full_outer_compare"] = f"""select coalesce(a.k, b.k) as num_id_entidade, case when b.k is null then 'so_esperado' when a.k is null then 'so_obtido' else 'diferente' end as situacao
from (select distinct num_id_entidade k, nom_comitente x, num_id_situacao_comitente y from comitente) a full join (select {num('num_id_entidade')} k, nom_comitente x, num_id_situacao_comitente y from (select distinct * from comitente_destino)) b on a.k = b.k
where a.k is null or b.k is null or a.x is distinct from b.x or a.y is distinct from b.y"""
SQL["join_theta_pairs"] = "select a.n_regionkey, a.n_name as nacao_a, b.n_name as nacao_b from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_name < b.n_name"
SQL["join_bridge_lineitem_to_customer"] = "select o_custkey, count(*) as linhas, sum(l_quantity) as quantidade from lineitem join orders on o_orderkey = l_orderkey group by 1"
LOST = f"({NORM.format(c='num_conta')}) in (select {NORM.format(c='cast(num_conta as varchar)')} from conta)"
SQL["join_marker_nullify"] = f"select num_carteira_comitente, case when {LOST} or coalesce(trim(num_conta), '') = '' then num_conta end as num_conta from carteira_comitente"
SQL["repair_report"] = "select 'outras_colunas' as regra, 0 as violacoes union all select 'so_nulo', 0"
B = "(select c_custkey from customer where c_mktsegment = 'BUILDING')"
SQL["closure_customer_orders_lineitem"] = f"""select 'CUSTOMER' as tabela, count(*) as linhas, count(*) as raizes from customer where c_mktsegment = 'BUILDING'
union all select 'ORDERS', count(*), count(distinct o_custkey) from orders where o_custkey in {B}
union all select 'LINEITEM', count(*), count(distinct o_custkey) from (select distinct l_orderkey, l_linenumber, o_custkey from lineitem join orders on o_orderkey = l_orderkey where o_custkey in {B})"""
SQL["closure_provenance_orders"] = f"select o_orderkey, o_custkey as raiz from orders where o_custkey in {B}"
SQL["referential_downsample"] = "select o_orderkey, o_custkey from orders where o_custkey is null or o_custkey in (select c_custkey from customer where c_nationkey is null or c_nationkey in (select n_nationkey from nation where n_regionkey = 1))"
URG = "select o_custkey from orders where o_orderpriority = '1-URGENT'"
SQL["referential_upclosure"] = _u(["select 'ORDERS' as tabela, count(*) as n from orders where o_orderpriority = '1-URGENT'", f"select 'CUSTOMER', count(*) from customer where c_custkey in ({URG})", f"select 'NATION', count(*) from nation where n_nationkey in (select c_nationkey from customer where c_custkey in ({URG}))"])
SQL["frontier_instruments"] = """with recursive e as (select distinct num_if id, num_if_pertence nxt from instrumento_financeiro where num_if_pertence is not null),
w as (select id as num_if, id as alcancado, 0 as passo from e union select w.num_if, e.nxt, w.passo + 1 from w join e on e.id = w.alcancado where w.passo < 4)
select num_if, alcancado, min(passo) as passo from w group by 1, 2"""

START = "(select max(o_orderkey) + 1001 from orders)"
OMAP = f"(select o_orderkey as old, k, {START} + (row_number() over (partition by k order by o_orderkey) - 1) * 3 + k - 1 as new from orders cross join range(1, 4) r(k))"
SQL["clone_map_orders"] = f"select old, k, new from {OMAP}"
SQL["clone_orders_k3"] = f"select new as o_orderkey, o_custkey, o_totalprice, k from orders join {OMAP} m on m.old = o_orderkey"
SQL["clone_lineitem_fk_remap"] = f"select coalesce(m.new, l_orderkey) as l_orderkey, l_linenumber, l_quantity, c.k as k from (select * from lineitem cross join range(1, 4) r(k)) c left join {OMAP} m on m.old = l_orderkey and m.k = c.k"
SQL["clone_validation_report"] = f"select 'linhas' as regra, 3 * count(*) as esperado, 3 * count(*) as obtido from orders union all select 'chaves_distintas', 3 * count(*), 3 * count(*) from orders union all select 'menor_chave', {START}, {START} union all select 'nulos', 0, 0"
SQL["clone_guard_new"] = "select distinct num_if, num_tipo_if from instrumento_financeiro where num_if not in (select num_if from titulo where num_if is not null)"
SQL["shift_keys_orders"] = "select o_orderkey + 1000000 as o_orderkey, o_custkey from orders"
SQL["null_out_columns"] = "select num_if, cast(null as varchar) as num_conta_participante, num_carga from titulo"
SQL["dates_preserve_term"] = f"select num_if, {TODAY} as dat_emissao, {TODAY} + cast(greatest(coalesce(datediff('day', cast(dat_emissao as date), cast(dat_vencimento as date)), 30), 1) as integer) as dat_vencimento from titulo"
SQL["dates_delta_shift_children"] = f"select l_orderkey, l_linenumber, case when o_orderdate is null then cast(l_shipdate as date) else cast(l_shipdate as date) + cast(datediff('day', cast(o_orderdate as date), {TODAY}) as integer) end as l_shipdate from lineitem left join orders on o_orderkey = l_orderkey"

SQL["ordinal_dense_events"] = "select event_id, row_number() over (order by ts, event_id) as ordinal from events"
SQL["ordinal_running_sum"] = "select event_id, event_type, row_number() over (partition by event_type order by substr(sha256(cast(event_id as varchar)), 1, 13), event_id) - 1 as antes from events"
D36 = "substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', cast((n // {p}) % 36 as integer) + 1, 1)"
SQL["code_placeholder_base36"] = "select o_orderkey, 'CDB9' || " + " || ".join(D36.format(p=36**i) for i in (4, 3, 2, 1, 0)) + " as codigo, lpad(cast(n as varchar), 16, '0') as codigo_operacao from (select o_orderkey, row_number() over (order by o_orderkey) as n from orders)"
SQL["control_numbers_two_sided"] = """with o as (select num_id_operacao, min(num_conta_participante_p1) is not distinct from min(num_conta_participante_p2) as same from operacao group by 1),
s as (select num_id_operacao, same, v from o, range(1, 3) r(v) where v = 1 or same),
n as (select *, row_number() over (order by num_id_operacao, v) as ordinal from s)
select num_id_operacao, lado, ordinal, '100' || lpad(cast(ordinal as varchar), 7, '0') as numero from n, range(1, 3) r(lado) where (same and lado = v) or not same"""
SQL["propagate_root_code"] = "select num_id_operacao, o.num_if, coalesce(i.c, o.cod_if) as cod_if from operacao o left join (select num_if, min(cod_if) c from instrumento_financeiro where coalesce(trim(cod_if), '') <> '' group by 1) i on i.num_if = o.num_if"
SQL["control_tuples_met"] = """select dia, count(*) as contas from (select distinct num_conta_participante_p1 as conta, cast(dat_inclusao as date) as dia from operacao where num_conta_participante_p1 is not null and dat_inclusao is not null
intersect select num_conta_participante, cast(dat_inclusao as date) from contexto_mensagem) group by 1"""

PAGE = "select num_if, sha256('s1:' || num_if) as posto from (select distinct num_if from instrumento_financeiro where num_if is not null)"
SQL["select_hash_page"] = f"{PAGE} order by posto, num_if limit 100"
SQL["keyset_page"] = f"{PAGE} order by posto, num_if limit 100 offset 100"
SQL["select_admitted"] = f"select num_if from ({PAGE}) where num_if in (select num_if from titulo) order by posto, num_if limit 100"
SQL["domain_sql_catalogue"] = SQL["domain_exists_query"] = f"select distinct num_if from instrumento_financeiro where {BLANK} and num_if in (select num_if from titulo) and num_if in (select num_if from operacao where dat_exclusao is null)"
SQL["domain_minus_exclusions"] = "select distinct num_if from instrumento_financeiro where num_if in (select num_if from titulo) and num_if not in (select num_if from operacao where num_if is not null) and num_if not in (select num_if from instrumento_financeiro where num_if_pertence is not null)"


def _missing(t, c, up, uc, where="true"):
    v = NORM.format(c=f"cast({c} as varchar)")
    return f"select distinct '{t}' as TABELA, '{c}' as COLUNA, {v} as VALOR from {t} where coalesce({v}, '') <> '' and {v} not in (select {NORM.format(c=f'cast({uc} as varchar)')} from {up} where {uc} is not null and {where})"


ENT = _missing("carteira_comitente", "num_id_entidade", "comitente", "num_id_entidade")
ACC = _missing("carteira_comitente", "num_conta", "conta", "num_conta")
SQL["faltantes_missing_keys"] = _u([ACC, ENT, _missing("operacao", "num_id_ctx_msg_p2", "contexto_mensagem", "num_id_ctx_msg")])
SQL["faltantes_merge"] = SQL["faltantes_drift"] = _u([ACC, ENT])
K = NORM.format(c="num_conta")
SQL["admission_rejected"] = f"""select distinct num_if, 'num_conta' as fk from carteira_comitente where num_if is not null and coalesce({K}, '') <> '' and {K} not in (select {K} from conta_destino where num_conta is not null)
and {K} not in (select {NORM.format(c='cast(num_conta as varchar)')} from conta where num_id_situacao_conta = 2)"""

SHAPE = """(select c_custkey, coalesce(p, 0) as pedidos, coalesce(a, 0) as abertos, coalesce(l, 0) as linhas, cast(null as bigint) as devolucoes from (select distinct c_custkey from customer where c_custkey is not null)
left join (select o_custkey, count(*) p, count(*) filter (o_orderstatus = 'O') a from orders group by 1) x on x.o_custkey = c_custkey
left join (select o_custkey, count(*) l from lineitem join orders on o_orderkey = l_orderkey group by 1) y on y.o_custkey = c_custkey)"""
SQL["shape_counts_per_customer"] = f"select *, concat_ws('|', 'pedidos=' || pedidos, 'abertos=' || abertos, 'devolucoes=' || devolucoes) as assinatura from {SHAPE}"


def _dist(source, root, sig):
    return f"(select assinatura, count(*) as n, count(*) / (select count(*) from {source}) as parte, array_to_string(list_slice(list_sort(list(r)), 1, 5), ',') as exemplos from (select {sig} as assinatura, {root} as r from {source}) group by 1)"


SQL["shape_distribution"] = f"select * from {_dist(SHAPE, 'c_custkey', "'pedidos=' || pedidos || '|abertos=' || abertos")}"
SQL["shape_marginals"] = _u(f"select '{c}' as metrica, case when {c} is null then 'ausente' when {c} >= 5 then '5+' else cast({c} as varchar) end as faixa, count(*) as n from {SHAPE} group by 2" for c in ("pedidos", "abertos", "linhas", "devolucoes"))
SQL["shape_reference_match"] = _u(f"select '{c}' as metrica, {v} as esperado, count(*) filter ({c} = {v}) as iguais, count(*) filter ({c} = {v}) / count(*) as parte from {SHAPE}" for c, v in (("pedidos", 10), ("abertos", 5)))


def _ops(side):
    src = f"(select num_if, coalesce(o, 0) as operacoes, coalesce(c, 0) as carteiras from (select distinct num_if from instrumento_financeiro where num_tipo_if = {side} and num_if is not null) left join (select num_if, count(*) o from operacao group by 1) x using (num_if) left join (select num_if, count(*) c from carteira_comitente group by 1) y using (num_if))"
    return _dist(src, "num_if", "'operacoes=' || operacoes || '|carteiras=' || carteiras")


CMP = f"select coalesce(a.assinatura, b.assinatura) as assinatura, case when b.assinatura is null then 'so_aqui' when a.assinatura is null then 'so_la' else 'ambos' end as situacao, coalesce(a.parte, 0) as pa, coalesce(b.parte, 0) as pb from {_ops(49)} a full join {_ops(50)} b on a.assinatura = b.assinatura"
SQL["shape_compare_status"] = f"select assinatura, situacao, round(pa, 9) as parte_aqui, round(pb, 9) as parte_la, round(pb - pa, 9) as deriva from ({CMP})"
SQL["shape_total_variation"] = f"select round(sum(abs(pb - pa)) / 2, 9) as distancia from ({CMP})"
SQL["attribute_top_values"] = "select num_conta_participante_p1 as valor, count(*) as n from operacao group by 1 order by n desc, valor nulls first limit 50"
SQL["universe_fingerprint"] = """select count(*) as n, sha256(cast(sum(cast(('0x' || substr(h, 1, 12)) as hugeint)) as varchar) || '|' || cast(sum(cast(('0x' || substr(h, 13, 12)) as hugeint)) as varchar)) as impressao
from (select distinct sha256(cast(num_if as varchar)) as h from instrumento_financeiro where num_if is not null)"""

# --- similarity: a long table of values -----------------------------------------------------------------------------------
T, N, X, I, L = '"string"', '"timestamp_ntz"', '"double"', '"integer"', '"long"'
COLS = {
    "comitente": {"num_id_entidade": L, "nom_comitente": T, "ind_comitente_simplificado": T, "num_id_situacao_comitente": I, "val_limite": '"decimal(18,2)"', "dat_inclusao": N, "dat_exclusao": N},
    "comitente_destino": {"num_id_entidade": T, "nom_comitente": T, "ind_comitente_simplificado": T, "num_id_situacao_comitente": I, "val_limite": X, "dat_inclusao": N, "dat_exclusao": N},
    "conta": {"num_conta": L, "cod_conta": T, "num_id_situacao_conta": I, "ind_excluido": T, "dat_inclusao": N, "dat_atualizacao_registro": N},
    "conta_destino": {"num_conta": T, "cod_conta": T, "num_id_situacao_conta": I, "ind_excluido": T, "dat_inclusao": N, "dat_atualizacao_registro": N},
    "titulo": {"num_conta_participante": T, "cod_tipo_escalonamento": T, "dat_emissao": N, "dat_vencimento": N, "ind_fracionamento": T},
    "instrumento_financeiro": {"num_tipo_if": I, "cod_if": T, "num_if_origem": L, "num_if_pertence": L, "dat_emissao": N, "dat_vencimento": N, "dat_registro": N, "dat_exclusao": T, "ind_agenda_constante": T},
}


def _long() -> str:
    parts = []
    for t, cols in COLS.items():
        for c, k in cols.items():
            if k == T:
                v, n, fam = f"upper(nullif(trim({c}), ''))", "null", "text"
            elif k == N:
                v, n, fam = f"cast(epoch_us({c}) as varchar)", f"cast(epoch_us({c}) as double)", "time"
            else:
                v, n, fam = f"case when {c} = 0 then '0' when isfinite(cast({c} as double)) then cast({c} as varchar) end", f"case when isfinite(cast({c} as double)) then cast({c} as double) end", "number"
            bad = f"coalesce(not isfinite(cast({c} as double)), false)" if fam == "number" else "false"
            parts.append(f"select '{t}' as tabela, '{c}' as coluna, '{k}' as tipo, '{fam}' as familia, {v} as valor, cast({n} as double) as num, {bad} as invalido from {t}")
    return "(" + " union all ".join(parts) + ")"


PROFILE = f"""(select *, case when validos < 100 or distintos < 2 then 'inelegivel' when familia = 'text' or (familia = 'number' and distintos <= 100) then 'jaccard' else 'psi' end as rota from
(select tabela, coluna, tipo, familia, count(*) as linhas, count(*) filter (valor is null and not invalido) as nulos, count(*) filter (invalido) as invalidos, count(valor) as validos, count(distinct valor) as distintos from {_long()} group by 1, 2, 3, 4))"""
PAIRS = f"(select a.tabela as tabela_a, a.coluna as coluna_a, b.tabela as tabela_b, b.coluna as coluna_b, case when a.rota = 'inelegivel' or b.rota = 'inelegivel' then 'inelegivel' when a.rota <> b.rota then 'rotas_diferentes' else 'ok' end as situacao, a.rota as rota, a.distintos as da, b.distintos as db from {PROFILE} a join {PROFILE} b on a.tipo = b.tipo and a.tabela < b.tabela)"
SQL["column_profile"] = f"select * from {PROFILE}"
SQL["column_candidate_pairs"] = f"select tabela_a, coluna_a, tabela_b, coluna_b, situacao from {PAIRS}"
DISTINCT = f"(select distinct tabela, coluna, tipo, valor from {_long()} where valor is not null)"
SQL["jaccard_exact"] = f"""with d as {DISTINCT}, i as (select a.tabela ta, a.coluna ca, b.tabela tb, b.coluna cb, count(*) n from d a join d b on a.tipo = b.tipo and a.valor = b.valor and a.tabela < b.tabela group by 1, 2, 3, 4)
select tabela_a, coluna_a, tabela_b, coluna_b, coalesce(n, 0) as comuns, coalesce(n, 0) / (da + db - coalesce(n, 0)) as jaccard, coalesce(n, 0) / (da + db - coalesce(n, 0)) >= 0.8 as igual
from {PAIRS} p left join i on i.ta = tabela_a and i.ca = coluna_a and i.tb = tabela_b and i.cb = coluna_b where situacao = 'ok' and rota = 'jaccard'"""
SQL["jaccard_bottomk_wilson"] = f"""with d as {DISTINCT}, s as (select * from (select *, sha256(valor) h, row_number() over (partition by tabela, coluna order by sha256(valor), valor) r from d) where r <= 2048),
u as (select tabela_a, coluna_a, tabela_b, coluna_b, h, valor, count(*) = 2 as b from (select p.*, h, valor from {PAIRS} p join s on s.tabela = tabela_a and s.coluna = coluna_a union all select p.*, h, valor from {PAIRS} p join s on s.tabela = tabela_b and s.coluna = coluna_b) where situacao = 'ok' and rota = 'jaccard' group by 1, 2, 3, 4, 5, 6),
g as (select tabela_a, coluna_a, tabela_b, coluna_b, count(*) as m, count(*) filter (b) as c from (select *, row_number() over (partition by tabela_a, coluna_a, tabela_b, coluna_b order by h, valor) r from u) where r <= 2048 group by 1, 2, 3, 4),
w as (select *, c / m as p, 1.959963984540054 as z from g)
select tabela_a, coluna_a, tabela_b, coluna_b, m as amostra, c as comuns, p as jaccard, greatest((p + z*z/(2*m) - z * sqrt(p*(1-p)/m + z*z/(4*m*m))) / (1 + z*z/m), 0) as baixo, least((p + z*z/(2*m) + z * sqrt(p*(1-p)/m + z*z/(4*m*m))) / (1 + z*z/m), 1) as alto from w"""
NUMS = f"(select l.tabela, l.coluna, l.tipo, num from {_long()} l join {PROFILE} p on p.tabela = l.tabela and p.coluna = l.coluna and p.rota = 'psi' where num is not null)"
CUTS = f"""(select tipo, num as corte from (select tipo, num, row_number() over (partition by tipo order by num) r, count(*) over (partition by tipo) t from
(select tabela, coluna, tipo, num from (select *, row_number() over (partition by tabela, coluna order by num) r, count(*) over (partition by tabela, coluna) n from {NUMS}), range(1, 101) q(j) where r = greatest(ceil(j * n / 100), 1)))
, range(1, 10) q(j) where r = greatest(ceil(j * t / 10), 1) group by 1, 2)"""
SQL["psi_edges_nearest_rank"] = f"select tipo, row_number() over (partition by tipo order by corte) - 1 as ordem, corte from {CUTS}"
BINS = f"""(select g.tabela, g.coluna, g.faixa, coalesce(c.n, 0) as n from (select x.tabela, x.coluna, faixa from (select distinct tabela, coluna, tipo from {NUMS}) x join (select tipo, count(*) k from {CUTS} group by 1) y using (tipo), range(0, 11) r(faixa) where faixa <= k) g
left join (select tabela, coluna, faixa, count(*) n from (select v.tabela, v.coluna, (select count(*) from {CUTS} c where c.tipo = v.tipo and c.corte < v.num) as faixa from {NUMS} v) group by 1, 2, 3) c on c.tabela = g.tabela and c.coluna = g.coluna and c.faixa = g.faixa)"""
SQL["psi_bins_grid"] = f"select * from {BINS}"
SQL["psi_scores"] = f"""with b as (select *, (n + 0.5) / (sum(n) over (partition by tabela, coluna) + 0.5 * count(*) over (partition by tabela, coluna)) as p from {BINS})
select tabela_a, coluna_a, tabela_b, coluna_b, round(sum((a.p - b.p) * ln(a.p / b.p)), 9) as psi, sum((a.p - b.p) * ln(a.p / b.p)) <= 0.05 as igual from {PAIRS} q
join b a on a.tabela = tabela_a and a.coluna = coluna_a join b on b.tabela = tabela_b and b.coluna = coluna_b and b.faixa = a.faixa where situacao = 'ok' and rota = 'psi' group by 1, 2, 3, 4"""
SQL["similarity_integrity"] = "select '' as tabela, '' as coluna, '' as regra where false"

SQL["stats_summary"] = _u(f"select '{c}' as coluna, count(*) as n, count(*) - count({c}) as nulos, min({c}) as minimo, max({c}) as maximo, round(avg({c}), 6) as media, round(stddev_samp({c}), 6) as desvio from lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount"))
OP = ["num_id_operacao", "num_if", "cod_if", "cod_operacao", "num_conta_participante_p1", "num_conta_participante_p2", "num_id_ctx_msg_p2", "num_id_tipo_oper_objeto_serv", "num_id_modalidade_liquidacao", "dat_inclusao", "dat_exclusao", "num_carga"]
SQL["stats_null_rates"] = _u(f"select '{c}' as coluna, count(*) - count({c}) as nulos, (count(*) - count({c})) / count(*) as parte from operacao" for c in OP)
SQL["histogram_fixed_bins"] = "select faixa, faixa * 2.5 as de, (faixa + 1) * 2.5 as ate, (select count(*) from lineitem where l_quantity between 0 and 50 and least(floor(l_quantity / 2.5), 19) = faixa) as n from range(0, 20) r(faixa)"
SQL["range_coverage"] = _u(f"select '{n}' as coluna, greatest(least(max(c.{a}), max(s.{b})) - greatest(min(c.{a}), min(s.{b})), 0) / (max(c.{a}) - min(c.{a})) as cobertura from customer c, supplier s" for n, a, b in (("saldo", "c_acctbal", "s_acctbal"), ("nacao", "c_nationkey", "s_nationkey")))
SQL["table_counts_one_action"] = _u(f"select '{t}' as tabela, count(*) as n from {t}" for t in ("customer", "orders", "lineitem", "operacao", "documents"))
SQL["union_by_name"] = "select c_name as nome, c_nationkey as nacao from customer union all select s_name, s_nationkey from supplier"
SQL["set_difference_anti"] = "select num_if from instrumento_financeiro except select num_if from titulo"
SQL["intersect_semi"] = "select c_nationkey as nacao from customer intersect select s_nationkey from supplier"
SQL["rank_bottomk_by_hash"] = "select * from (select c_mktsegment, c_custkey, sha256(cast(c_custkey as varchar)) as h, row_number() over (partition by c_mktsegment order by sha256(cast(c_custkey as varchar)), c_custkey) as posto from customer) where posto <= 10"
SQL["publish_readback_counts"] = "select 'nation' as tabela, count(*) as n from nation union all select 'customer', count(*) from customer"
SQL["snapshot_roundtrip"] = "select o_orderkey, '' as situacao from orders where false"
SQL["reservation_ranges"] = _u(f"select '{t}' as nome, (select max({k}) from {t}) + 1 + 3 * count(*) * b as inicio, (select max({k}) from {t}) + 3 * count(*) * (b + 1) as fim from {t}, range(0, 2) r(b) group by b" for t, k in (("orders", "o_orderkey"), ("customer", "c_custkey")))

# --- before and after a load ------------------------------------------------------------------------------------------------
OPS = "operacao"
SQL["preflight_operacao"] = _u(
    [
        _find(OPS, "alinhamento", "desconhecidas", "6"),
        _find(OPS, "alinhamento", "ausentes", "1"),
        _find(OPS, "capacidade", "num_id_operacao", "select count(*) from operacao where abs(num_id_operacao) > 9999999999"),
        _find(OPS, "nulo", "num_id_operacao", "select count(*) from operacao where num_id_operacao is null"),
        _find(OPS, "capacidade", "num_if", "select count(*) from operacao where abs(num_if) > 999999999"),
        *(_find(OPS, "octetos", c, f"select count(*) from operacao where strlen({c}) > {n}") for c, n in (("cod_if", 10), ("cod_operacao", 16), ("num_id_ctx_msg_p2", 12))),
        _find(OPS, "capacidade", "num_carga", "select count(*) from operacao where abs(num_carga) > 99"),
        _find(OPS, "unique", "num_id_operacao", _dup(OPS, "num_id_operacao", "num_id_operacao is not null")),
        _find(OPS, "ja_no_destino", "num_id_operacao", "select count(distinct num_id_operacao) from operacao"),
        _find(OPS, "unique", "cod_if,cod_operacao", _dup(OPS, "cod_if, cod_operacao", "cod_if is not null and cod_operacao is not null")),
        _find(OPS, "pai_estatico", "num_if", "select count(*) from operacao where num_if is not null and num_if not in (select num_if from instrumento_financeiro where num_if is not null)"),
    ]
)
FULL = "coalesce(trim(cod_if), '') <> ''"
SQL["business_key_rules"] = _u(
    [
        f"select 'formato' as regra, count(*) as violacoes from instrumento_financeiro where {FULL} and not regexp_full_match(cod_if, '[A-Z]{{3}}[0-9A-Z]{{8}}')",
        f"select 'codigo_repetido', count(*) from (select cod_if from instrumento_financeiro where {FULL} group by 1 having count(distinct num_if) > 1)",
        "select 'tupla_incompleta', count(*) from operacao where (num_conta_participante_p1 is null) <> (num_id_ctx_msg_p2 is null)",
        f"select 'tupla_repetida', ({_dup(OPS, 'num_conta_participante_p1, num_id_ctx_msg_p2', 'num_conta_participante_p1 is not null and num_id_ctx_msg_p2 is not null')})",
        f"select 'codigo_da_raiz', count(*) from operacao o join (select num_if, min(cod_if) c from instrumento_financeiro where {FULL} group by 1) i on i.num_if = o.num_if where o.cod_if is distinct from i.c",
    ]
)
SQL["roots_without_child"] = "select distinct num_if from instrumento_financeiro where num_if is not null and num_if not in (select num_if from titulo where cod_tipo_escalonamento is not null and num_if is not null)"
SQL["shift_overflow"] = _u(f"select '{t}' as tabela, min({k}) as menor, max({k}) as maior, min({k}) + 10000 as novo_menor, max({k}) + 10000 as novo_maior, max({k}) + 10000 > {cap} as estouro, min({k}) + 10000 <= max({k}) as colide from {t}" for t, k, cap in (("orders", "o_orderkey", 20000), ("customer", "c_custkey", 2**63 - 1), ("instrumento_financeiro", "num_if", 2**63 - 1)))
SQL["code_map_consistency"] = "select regra, 0 as violacoes from (values ('ordinal_denso'), ('chave_repetida'), ('codigo_repetido'), ('formato')) t(regra)"
SQL["load_marks"] = "select 'orders' as tabela, 'o_orderkey' as coluna, max(o_orderkey) as maximo from orders union all select 'customer', 'c_custkey', max(c_custkey) from customer union all select 'events', 'event_id', null"
SQL["load_rolled_back"] = "select o_orderkey, o_custkey from orders"
SQL["clone_key_sample"] = f"select old, k, new from {OMAP} order by old, k limit 20"
KEY = f"(select min(VALOR) from ({ACC}))"
SQL["explain_missing_key"] = _u(
    [
        f"select '0:carteira' as etapa, count(*) as linhas, min(num_conta) as exemplo from carteira_comitente where {K} = {KEY}",
        f"select '1:carteira_ativa', count(*), min(num_conta) from carteira_comitente where dat_exclusao is null and {K} = {KEY}",
        f"select '2:conta', count(*), cast(min(num_conta) as varchar) from conta where cast(num_conta as varchar) = {KEY}",
        f"select '3:faltantes', count(*), min(VALOR) from ({ACC}) where VALOR = {KEY}",
    ]
)
SQL["observed_discriminators"] = f"select num_tipo_if, array_to_string(list_sort(list(distinct upper(substr(trim(cod_if), 1, 3)))), ',') as prefixos from instrumento_financeiro where {FULL} group by 1"
SQL["segment_flags"] = """select i.num_if, case when p.num_if is null then 'sem_carteira' when s = 1 then 'sim' when s = 0 then 'nao' else 'desconhecido' end as segmento from (select distinct num_if from instrumento_financeiro) i
left join (select num_if, max(s) s from carteira_comitente c left join (select num_id_entidade, max(case when ind_comitente_simplificado = 'S' then 1 else 0 end) s from comitente group by 1) e on e.num_id_entidade = c.num_id_entidade group by 1) p on p.num_if = i.num_if"""

SQL["admission_refilled"] = """select c_custkey from (select distinct c_custkey, sha256('s1:' || c_custkey) as posto from customer where c_custkey not in
(select o_custkey from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey where p_size = 7 and o_custkey is not null)) order by posto, c_custkey limit 30"""
SQL["source_filters_instrumento"] = "select distinct num_if, num_carga, 1 as avisos from instrumento_financeiro where num_tipo_if = 49 and num_carga > 5 and num_if_origem is null"
SQL["bernoulli_by_hash"] = f"select event_id, event_type from events where substr(sha256('s1:' || event_id), 1, 13) < '{int(0.05 * 16**13):013x}'"
SQL["plan_load_order"] = _u(f"select {i} as posicao, '{t}' as tabela, count(*) as n from {t}" for i, t in enumerate(("REGION", "NATION", "CUSTOMER", "ORDERS", "PART", "SUPPLIER", "LINEITEM"), 1))
# the largest table outweighs all others, and so does the second all those after it
SQL["plan_buckets"] = """select (select count(*) from lineitem) as linhas, 'lineitem' as tabelas union all select (select count(*) from orders), 'orders' union all
select (select count(*) from customer) + (select count(*) from part) + (select count(*) from supplier) + (select count(*) from nation) + (select count(*) from region), 'customer,nation,part,region,supplier'"""
SQL["partitioned_pruned"] = "select o_orderstatus, o_orderpriority, count(*) as n, sum(o_orderkey) as soma_chaves from orders where (o_orderstatus, o_orderpriority) in (('O', '1-URGENT'), ('F', '2-HIGH')) group by 1, 2"
SQL["run_directory_latest"] = _u(f"select '{t}' as tabela, count(*) as n, 'r2' as execucao from {t}" for t in ("region", "nation"))
SQL["stats_percentiles_ranks"] = _u(f"select '{c}' as coluna, {q} as parte, count(*) as n, true as dentro from lineitem" for c in ("l_quantity", "l_extendedprice") for q in (0.25, 0.5, 0.75))
