"""The same results in SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

BL = r"' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"


def clean(c: str) -> str:
    return f"nullif(trim(cast({c} as varchar), {BL}), '')"


def num(c: str) -> str:
    return f"try_cast(try_cast({clean(c)} as decimal(38,10)) as bigint)"


RULED = {"instrumento_financeiro": ("num_if", "dat_exclusao"), "titulo": ("num_if", "cod_tipo_escalonamento"), "resgate": ("num_condicao_if", "cod_cond_resgate")}


def p1_found() -> str:
    parts = []
    for t, (k, c) in RULED.items():
        date = c == "dat_exclusao"
        v = clean(c) if date else f"upper({clean(c)})"
        base = f"(select distinct {k} k, num_carga g, {v} v from {t})"
        name = f"'{t}' as tabela, '{c}' as coluna"
        if date:
            at = r"case when regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}') then try_strptime(v, '%Y-%m-%d %H:%M:%S') end"
            low = f"(select min(cast(conteudo as timestamp)) from dominio_coluna where coluna = '{c}' and tipo_regra = 'minimo')"
            parts.append(f"select {name}, 'formato' as achado, g as num_carga, k as chave from (select *, {at} as a from {base}) where v is not null and a is null")
            parts.append(f"select {name}, 'faixa', g, k from (select *, {at} as a from {base}) b left join (select distinct num_carga, dat_carga from carga) c on c.num_carga = b.g where a < {low} or a > dat_carga")
            parts.append(f"select {name}, 'concentracao', g, 0 from (select g, max(n) m, sum(n) s from (select g, cast(a as date) d, count(*) n from (select *, {at} as a from {base}) where a is not null group by 1, 2) group by 1) where s >= 10 and m / s > 0.40")
        else:
            dom = f"(select upper(trim(conteudo)) from dominio_coluna where tabela = '{t}' and coluna = '{c}' and tipo_regra = 'valor')"
            parts.append(f"select {name}, 'dominio' as achado, g as num_carga, k as chave from {base} where v is not null and v not in {dom}")
            q = f"(select l.g, d.v, coalesce(x.n, 0) / l.n as q from (select g, count(*) n from {base} where v in {dom} group by 1) l cross join (select distinct v from {base} where v in {dom}) d left join (select g, v, count(*) n from {base} where v in {dom} group by 1, 2) x on x.g is not distinct from l.g and x.v = d.v)"
            p = f"(select v, count(*) / (select count(*) from {base} where v in {dom}) as p from {base} where v in {dom} group by 1)"
            parts.append(f"select {name}, 'distribuicao', g, 0 from (select g, sum(abs(q - p)) / 2 as s from {q} q join {p} p using (v) group by 1) where s > 0.30")
        share = f"(select g, count(*) filter (v is null) / count(*) as s from {base} group by 1)"
        parts.append(f"select {name}, 'nulos', g, 0 from {share} where abs(s - (select median(s) from {share})) > 0.15")
    return " union all ".join(f"({p})" for p in parts)


REFS = [
    ("carteira_comitente", "num_id_entidade", "num_carteira_comitente", "comitente", "num_id_entidade", "dat_exclusao is null"),
    ("carteira_comitente", "num_conta", "num_carteira_comitente", "conta", "num_conta", "coalesce(trim(ind_excluido), '') not in ('S', 'Y', '1')"),
    ("operacao", "num_id_ctx_msg_p2", "num_id_operacao", "contexto_mensagem", "num_id_ctx_msg", "dat_exclusao is null"),
]


def p3_found() -> str:
    parts = []
    for t, c, k, target, tk, active in REFS:
        parts.append(
            f"""select distinct '{t}' as tabela, '{c}' as coluna, r.k as chave,
            case when x.k is null then 'ausente' when x.n = 0 then 'excluido' else 'posterior' end as situacao, strftime(r.born, '%Y-%m') as periodo
            from (select {k} k, {num(c)} ref, dat_inclusao as born from {t} where dat_exclusao is null and {clean(c)} is not null) r
            left join (select {num(tk)} k, count(*) filter ({active}) n, min(coalesce(dat_inclusao, timestamp '0001-01-01')) filter ({active}) f from {target} where {num(tk)} is not null group by 1) x on x.k = r.ref
            where x.k is null or x.n = 0 or x.f > r.born"""
        )
    return " union all ".join(f"({p})" for p in parts)


def p3_contagens() -> str:
    parts = []
    for t, c, _, target, tk, active in REFS:
        parts.append(
            f"""select '{t}.{c}' as referencia, r.k as chave, r.n as refs, coalesce(x.a, 0) as active, coalesce(x.e, 0) as ever
            from (select {num(c)} k, count(*) n from (select distinct * from {t}) where dat_exclusao is null and {num(c)} is not null group by 1) r
            left join (select {num(tk)} k, count(*) e, count(*) filter ({active}) a from (select distinct * from {target}) group by 1) x on x.k = r.k where coalesce(x.a, 0) = 0"""
        )
    return " union all ".join(f"({p})" for p in parts)


TREE = """with recursive n as (
  select distinct 'pertence' h, num_if id, num_if_pertence p from instrumento_financeiro union select distinct 'origem', num_if, num_if_origem from instrumento_financeiro),
l as (select n.h, n.id, n.p as link, m.id as p from n left join n m on m.h = n.h and m.id = n.p),
up as (
  select h, id, id as top, p as nxt, 0 as steps, [id] as seen from l
  union all
  select up.h, up.id, l.id, l.p, steps + 1, list_append(seen, l.id) from up join l on l.h = up.h and l.id = up.nxt where not list_contains(seen, up.nxt)),
last as (select *, row_number() over (partition by h, id order by steps desc) as r from up),
fin as (select h, id, top, nxt, steps, seen from last where r = 1),
circ as (select h, id, list_min(list_slice(seen, list_position(seen, nxt), len(seen))) as root, nxt, list_position(seen, nxt) as pos from fin where nxt is not null)
"""


def p4_found() -> str:
    return TREE + """select l.h as hierarquia, l.id as num_if, coalesce(c.root, f.top) as num_if_raiz, case when c.root is not null then -1 else f.steps end as profundidade
from l join fin f using (h, id) left join circ c using (h, id) where l.link is not null"""


def p4_caminhos() -> str:
    return TREE + """, sized as (select h, a as id, count(*) n from (select h, unnest(case when nxt is null then seen else list_slice(seen, 1, list_position(seen, nxt)) end) as a, id from fin) group by 1, 2)
select f.h as hierarquia, f.id as num_if, coalesce(c.root, f.top) as num_if_raiz, case when c.root is not null then -1 else f.steps end as profundidade,
array_to_string(list_reverse(case when f.nxt is null then f.seen else list_slice(f.seen, 1, c.pos) end), '/') as caminho, s.n as tamanho
from fin f left join circ c using (h, id) join sized s using (h, id)"""


def p4_descendentes() -> str:
    return TREE + """, e as (select h, id, case when nxt is null then seen else list_slice(seen, 1, list_position(seen, nxt)) end as s from fin)
select h as hierarquia, s[i] as num_if, id as num_if_abaixo, i - 1 as passos from (select h, id, s, unnest(range(2, len(s) + 1)) as i from e)"""


def p4_circulos() -> str:
    return TREE + "select h as hierarquia, root as circulo, id as num_if from circ where pos = 1"


P5 = {
    "comitente": ("comitente_destino", "num_id_entidade", {"nom_comitente": "t", "ind_comitente_simplificado": "t", "num_id_situacao_comitente": "n", "val_limite": "c", "dat_inclusao": "s", "dat_exclusao": "s"}),
    "conta": ("conta_destino", "num_conta", {"cod_conta": "t", "num_id_situacao_conta": "n", "ind_excluido": "t", "dat_inclusao": "s", "dat_atualizacao_registro": "s"}),
}


def _norm(c: str, k: str) -> str:
    return {"t": clean(c), "n": f"cast({num(c)} as varchar)", "c": f"cast(cast(round({c}, 2) as decimal(38,2)) as varchar)", "s": f"strftime({c}, '%Y-%m-%d %H:%M:%S')"}[k]


def _both(t: str) -> str:
    copy, key, fields = P5[t]
    side = lambda x: f"(select distinct {num(key)} as k, {', '.join(f'{_norm(c, k)} as {c}' for c, k in fields.items())} from {x})"
    return f"{side(t)} a full join {side(copy)} b on a.k = b.k"


def p5_found() -> str:
    parts = []
    for t, (_, _, fields) in P5.items():
        parts.append(f"select '{t}' as tabela, coalesce(a.k, b.k) as chave, '' as coluna, case when b.k is null then 'so_origem' else 'so_destino' end as diferenca from {_both(t)} where a.k is null or b.k is null")
        for c in fields:
            parts.append(f"select '{t}', a.k, '{c}', 'valor' from {_both(t)} where a.k = b.k and a.{c} is distinct from b.{c}")
    return " union all ".join(f"({p})" for p in parts)


def p5_diferencas() -> str:
    parts = [f"(select '{t}' as tabela, a.k as chave, 1 as versao, '{c}' as campo, a.{c} as esquerda, b.{c} as direita from {_both(t)} where a.k = b.k and a.{c} is distinct from b.{c})" for t, (_, _, fields) in P5.items() for c in fields]
    return " union all ".join(parts)


def p5_versoes() -> str:
    fields = {"num_id_entidade": "n"} | {c: k for c, k in P5["comitente"][2].items() if c != "num_id_situacao_comitente"}
    side = lambda x: f"(select distinct {num('num_id_situacao_comitente')} as k, {', '.join(f'{_norm(c, k)} as {c}' for c, k in fields.items())} from {x})"
    order = ", ".join(f"{c} nulls first" for c in fields)
    ranked = lambda x, y: f"(select *, row_number() over (partition by k order by {order}) as v from (select * from {side(x)} except select * from {side(y)}))"
    both = f"{ranked('comitente', 'comitente_destino')} a full join {ranked('comitente_destino', 'comitente')} b on a.k is not distinct from b.k and a.v = b.v"
    kind = "case when b.v is null then 'so_origem' when a.v is null then 'so_destino' else 'valor' end"
    return " union all ".join(f"(select coalesce(a.k, b.k) as chave, coalesce(a.v, b.v) as versao, {kind} as situacao, '{c}' as campo, a.{c} as esquerda, b.{c} as direita from {both} where a.{c} is distinct from b.{c})" for c in fields)


def p5_resumo() -> str:
    parts = []
    for t, (_, _, fields) in P5.items():
        differ = " or ".join(f"a.{c} is distinct from b.{c}" for c in fields)
        parts.append(f"(select '{t}' as tabela, situacao, count(*) as n from (select case when b.k is null then 'so_origem' when a.k is null then 'so_destino' when {differ} then 'valor' else 'igual' end as situacao from {_both(t)}) group by 2)")
    return " union all ".join(parts)


COLUMNS = {
    "instrumento_financeiro": ["num_if", "num_tipo_if", "cod_if", "num_if_origem", "num_if_pertence", "dat_emissao", "dat_vencimento", "dat_registro", "dat_exclusao", "ind_agenda_constante"],
    "titulo": ["num_if", "num_conta_participante", "cod_tipo_escalonamento", "dat_emissao", "dat_vencimento", "ind_fracionamento"],
    "resgate": ["num_condicao_if", "cod_cond_resgate", "cod_tipo_exercicio", "dat_resgate", "dat_exclusao"],
}


def _values() -> str:
    return "(" + " union all ".join(f"select '{t}' as tabela, '{c}' as coluna, num_carga, {clean(c)} as v from (select distinct * from {t})" for t, cols in COLUMNS.items() for c in cols) + ")"


def p1_perfil() -> str:
    return f"""select tabela, coluna, num_carga, sum(n) as linhas, sum(case when v is null then n else 0 end) as vazios, count(v) as distintos, max(n) as n_mais_comum,
    min(v) as minimo_texto, max(v) as maximo_texto, min(try_cast(v as double)) as minimo_numero, max(try_cast(v as double)) as maximo_numero
    from (select tabela, coluna, num_carga, v, count(*) as n from {_values()} group by 1, 2, 3, 4) group by 1, 2, 3"""


EXACT = ((r"\p{Lu}", "A"), (r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]", "a"), (r"\p{Nd}", "9"))


def _masked(exact: bool = False) -> str:
    m = "v"
    for a, b in EXACT if exact else ((r"\p{Lu}+", "A"), (r"[\p{L}--A]+", "a"), (r"\p{Nd}+", "9"), (r"\s+", " "), ("[Aa]+ [Aa ]*[Aa]", "a a")):
        if "--" in a:
            a = r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]+"
        m = f"regexp_replace({m}, '{a}', '{b}', 'g')"
    return f"(select tabela, coluna, num_carga, v, {m} as mascara from {_values()})"


def p1_padroes(exact: bool = False) -> str:
    return f"""select tabela, coluna, mascara, n, exemplo, n / t as parte, n / t >= 0.01 as dominante from
    (select *, sum(n) over (partition by tabela, coluna) as t from (select tabela, coluna, mascara, count(*) as n, min(v) as exemplo from {_masked(exact)} where v is not null group by 1, 2, 3))"""


def p1_mascaras_raras(exact: bool = False) -> str:
    return f"""select tabela, coluna, num_carga, mascara, count(*) as n, min(v) as exemplo from {_masked(exact)} m
    where v is not null and (tabela, coluna, mascara) not in (select (tabela, coluna, mascara) from ({p1_padroes(exact)}) where dominante) group by 1, 2, 3, 4"""


def p1_divergencia(exact: bool = False) -> str:
    c = f"(select tabela, coluna, num_carga, coalesce(mascara, '') as m, count(*) as n from {_masked(exact)} group by 1, 2, 3, 4)"
    return f"""with c as {c}, p as (select tabela, coluna, m, sum(n) / sum(sum(n)) over (partition by tabela, coluna) as p from c group by 1, 2, 3),
    l as (select tabela, coluna, num_carga, sum(n) as t from c group by 1, 2, 3)
    select l.tabela, l.coluna, l.num_carga, round(sum(abs(coalesce(c.n, 0) / l.t - p.p)) / 2, 9) as divergencia from l join p on p.tabela = l.tabela and p.coluna = l.coluna
    left join c on c.tabela = l.tabela and c.coluna = l.coluna and c.num_carga is not distinct from l.num_carga and c.m = p.m group by 1, 2, 3"""


SQL = {
    "p1_found": p1_found(),
    "p1_perfil": p1_perfil(),
    "p1_padroes": p1_padroes(),
    "p1_mascaras_raras": p1_mascaras_raras(),
    "p1_divergencia": p1_divergencia(),
    "p1_padroes_exatos": p1_padroes(True),
    "p1_mascaras_raras_exatas": p1_mascaras_raras(True),
    "p1_divergencia_exata": p1_divergencia(True),
    "p3_found": p3_found(),
    "p3_periodos": f"select tabela, coluna, periodo, situacao, count(*) as n from ({p3_found()}) group by 1, 2, 3, 4",
    "p3_contagens": p3_contagens(),
    "p4_found": p4_found(),
    "p4_caminhos": p4_caminhos(),
    "p4_descendentes": p4_descendentes(),
    "p4_circulos": p4_circulos(),
    "p5_found": p5_found(),
    "p5_diferencas": p5_diferencas(),
    "p5_versoes": p5_versoes(),
    "p5_resumo": p5_resumo(),
}
