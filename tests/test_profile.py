import datetime as dt

from conftest import rows

from sondar.functions.text import mask
from sondar.operators import profile
from sondar.operators.profile import Rule

LOADS = [(1, dt.datetime(2024, 8, 2)), (2, dt.datetime(2024, 9, 2))]
CODES = Rule("t", "cod", "k", codes=("COM TABELA", "MERCADO"))
DATES = Rule("t", "dat", "k", form="AAAA-MM-DD HH:MM:SS", least="2016-01-01 00:00:00", to_load_date=True)


def loads(spark):
    return spark.createDataFrame(LOADS, "num_carga int, dat_carga timestamp_ntz")


def test_rules_from_domains(spark):
    d = spark.createDataFrame([("t", "cod", "valor", " Mercado"), ("t", "cod", "valor", "COM TABELA"), ("t", "dat", "formato", "AAAA-MM-DD HH:MM:SS"), ("t", "dat", "minimo", "2016-01-01 00:00:00"), ("t", "dat", "maximo", "carga.dat_carga"), ("x", "y", "valor", "Z")], "tabela string, coluna string, tipo_regra string, conteudo string")
    assert profile.rules_of(d, {"t": "k"}) == [CODES, DATES]
    assert DATES.masks() == ["9999-99-99 99:99:99"] and DATES.pattern() == "yyyy-MM-dd HH:mm:ss"
    assert CODES.masks() == ["AAA AAAAAA", "AAAAAAA"]


def cases(df, rules, spark, scratch):
    v = scratch.keep(profile.values(df, rules).distinct())
    return profile.value_cases(v, profile.class_counts(v, rules), rules, loads(spark), profile.ProfileConfig())


def test_code_values(spark, scratch):
    data = [(1, "mercado ", 1), (2, "MERCAD0", 1), (3, "MISTOOO", 1), (4, None, 1), (5, "  ", 1), (6, "\tCOM TABELA\n", None), (7, "COM  TABELA", None), (7, "COM  TABELA", None), (None, "X", 2)]
    df = spark.createDataFrame([(*r, "z", "z") for r in data], "k bigint, cod string, num_carga int, valor string, mascara string")
    got = rows(cases(df, [CODES], spark, scratch), "chave", "num_carga", "achado")
    assert got == sorted([(2, 1, "dominio"), (3, 1, "dominio"), (7, None, "dominio"), (None, 2, "dominio")], key=repr)


def test_date_values(spark, scratch):
    data = ["2024-07-01 10:00:00", " 2024-07-01 10:00:00 ", "2024-02-30 00:00:00", "0000-00-00 00:00:00", "2024-07-01", "2024-07-01 24:00:00", "2015-12-31 23:59:59", "2016-01-01 00:00:00", "2024-08-02 00:00:00", "2024-08-02 00:00:01", "N/A", "", None, "2024-07-01T10:00:00", "2024-13-01 00:00:00", "2023-02-29 00:00:00", "2024-02-29 00:00:00"]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(data)] + [(99, "2030-01-01 00:00:00", None)], "k bigint, dat string, num_carga int")
    got = {r.chave: r.achado for r in cases(df, [DATES], spark, scratch).collect()}
    assert got == {2: "formato", 3: "formato", 4: "formato", 5: "formato", 6: "faixa", 9: "faixa", 10: "formato", 13: "formato", 14: "formato", 15: "formato"}


def test_load_cases(spark, scratch):
    data, k = [], 0
    for load in range(1, 6):
        for i in range(20):
            k += 1
            empty = i < (12 if load == 3 else 4)
            code = None if empty else "MERCADO" if (load == 5 or i % 2) else "COM TABELA"
            day = dt.date(2024, 7, 1) if load == 2 and i < 15 else dt.date(2024, 6, 1) + dt.timedelta(days=i)
            data.append((k, code, load, None if empty and load != 2 else f"{day} 00:00:00"))
    df = spark.createDataFrame(data + data[:7], "k bigint, cod string, num_carga int, dat string")
    rules = [CODES, DATES]
    v = scratch.keep(profile.values(df, rules).distinct())
    got = rows(profile.load_cases(scratch.keep(profile.class_counts(v, rules)), rules))
    codes, dates = ([x[1:] for x in got if x[0] == c] for c in ("t.cod", "t.dat"))
    assert codes == [(3, "nulos"), (5, "distribuicao")]
    assert (2, "concentracao") in dates and (3, "nulos") in dates and len([x for x in dates if x[1] == "concentracao"]) == 1


def test_a_legal_code_behind_a_rare_mask_and_an_illegal_one_behind_a_common_mask(spark, scratch):
    data = [(i, "MERCADO", 1) for i in range(400)] + [(900, "COM TABELA", 1), (901, "MERDACO", 1), (902, "M3RCADO", 1)]
    df = spark.createDataFrame([(*r, None) for r in data], "k bigint, cod string, num_carga int, dat string")
    got = rows(profile.found({"t": df}, [CODES, DATES], loads(spark), scratch))
    assert got == [("t", "cod", "dominio", 1, 901), ("t", "cod", "dominio", 1, 902)]


def test_found_on_nothing(spark, scratch):
    df = spark.createDataFrame([], "k bigint, cod string, dat string, num_carga int")
    assert profile.found({"t": df}, [CODES, DATES], loads(spark), scratch).collect() == []
    for f in (profile.column_profile, lambda x: profile.patterns(profile.mask_counts(x)), lambda x: profile.rare(profile.mask_counts(x)), lambda x: profile.mask_divergence(profile.mask_counts(x))):
        assert f(df).collect() == []


def test_profile_of_any_table(spark, scratch):
    data = [(1, "Ab-12", 1.5, 1), (1, "Ab-12", 1.5, 1), (2, " ", None, 1), (3, "ção " * 20_000, float("nan"), 1), (10, "??", 2.0, 2), (9, None, 2.0, None)]
    df = spark.createDataFrame(data, "`a.b` int, coluna string, valor double, num_carga int")
    p = {(r.coluna, r.num_carga): r for r in profile.column_profile(df).collect()}
    assert p["coluna", 1].linhas == 3 and p["coluna", 1].vazios == 1 and p["coluna", 1].distintos == 2
    assert p["a.b", 1].minimo_numero == 1 and p["a.b", 1].maximo_numero == 3 and p["a.b", None].linhas == 1
    counts = scratch.keep(profile.mask_counts(df))
    masks = {r.mascara for r in profile.patterns(counts).where("coluna = 'coluna'").collect()}
    assert masks == {"Aa-9", "a a", "??"}
    d = {(r.coluna, r.num_carga): r.divergencia for r in profile.mask_divergence(counts).collect()}
    # load 2 has the mask ?? alone, which one of five rows has over all loads
    assert abs(d["coluna", 2] - 0.8) < 1e-9


def test_rare_masks(spark, scratch):
    df = spark.createDataFrame([(i, f"A{i % 10}", 1 + i % 2) for i in range(300)] + [(1000, "x-y", 2)], "k int, c string, num_carga int")
    counts = scratch.keep(profile.mask_counts(df))
    rare = [(r.coluna, r.num_carga, r.mascara, r.n, r.exemplo) for r in profile.rare(counts).where("coluna = 'c'").collect()]
    assert rare == [("c", 2, "a-a", 1, "x-y")]


def test_exact_masks_tell_lengths_and_words_apart(spark, scratch):
    data = [(i, "COM TABELA", 1 + i % 2) for i in range(300)] + [(1000, "COM TABEL", 2), (1001, "CO MTABELA", 2), (1002, "COMTABELA", 1), (1003, "ção " * 20_000, 1)]
    df = spark.createDataFrame(data, "k int, c string, num_carga int")
    counts = scratch.keep(profile.mask_counts(df, form=mask))
    rare = {(r.num_carga, r.mascara, r.n, r.exemplo) for r in profile.rare(counts).where("coluna = 'c'").collect()}
    assert rare == {(2, "AAA AAAAA", 1, "COM TABEL"), (2, "AA AAAAAAA", 1, "CO MTABELA"), (1, "AAAAAAAAA", 1, "COMTABELA"), (1, " ".join(["aaa"] * 20_000), 1, " ".join(["ção"] * 20_000))}
    assert {r.mascara for r in profile.patterns(counts).where("coluna = 'c' and dominante").collect()} == {"AAA AAAAAA"}
    d = {r.num_carga: r.divergencia for r in profile.mask_divergence(counts).where("coluna = 'c'").collect()}
    # by hand: 150 of 152 values in each load have the common mask, 300 of 304 in all; each rare one is 1 of 152 in its own load, 1 of 304 in all
    assert all(abs(d[g] - 2 / 304) < 1e-9 for g in (1, 2))
