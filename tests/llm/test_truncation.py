import json
import random

from pyspark.sql import functions as F

from sondar.llm import truncation


def plain_lengths(t):
    x = t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;").replace("'", "&apos;")
    return {
        "caracteres": len(t), "utf8": len(t.encode()), "utf16": len(t.encode("utf-16-le")) // 2, "crlf": len(t.replace("\n", "\r\n")), "crlf_utf8": len(t.replace("\n", "\r\n").encode()),
        "xml": len(x) - t.count("'"), "xml_utf8": len(x.encode()) - t.count("'"), "entidades": len(t.encode("ascii", "xmlcharrefreplace")), "xml_entidades": len(x.encode("ascii", "xmlcharrefreplace")) - t.count("'"),
        "json": len(json.dumps(t, ensure_ascii=False)) - 2, "json_utf8": len(json.dumps(t, ensure_ascii=False).encode()) - 2, "json_ascii": len(json.dumps(t)) - 2,
    }


def test_lengths_against_the_encodings_themselves(spark):
    texts = ["simples", "ação\nlinha", 'a "b" & <c> \'d\'', "😀 ½ 中文 \t\\ \r", "€€ ﬁ", "x" * 5000 + "é" * 300, "&#233;"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "'f' as source")
    got = {r.doc_id: r.tamanhos.asDict() for r in truncation.prepared(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_lengths(t), t


WORDS = "contrato prevê atualização mensal acrescida de taxa sobre saldo devedor conforme item manual carteira comitente registro".split()


def sentence(rng, n=9):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def corpus(rng, n=600):
    """Texts of four sources and whether they were cut: by characters, by bytes, in transfer, and whole ones."""
    rows, cut, i = [], set(), 0

    def add(text, source, is_cut):
        nonlocal i
        i += 1
        rows.append((i, text, source))
        if is_cut:
            cut.add(i)

    for _ in range(n):
        t = " ".join(sentence(rng) for _ in range(rng.randint(1, 8)))
        add(t[:255], "Obs ", len(t) > 255 and t[:255].rstrip()[-1] != ".")
        b = " ".join(sentence(rng) for _ in range(rng.randint(1, 8))) + "\nObrigado"
        short = b.encode()[:300].decode(errors="replace")
        add(short, "chamado", short != b and short.rstrip()[-1] != ".")
        m = "<Msg cod=\"1\"><D>" + sentence(rng) + "</D>\n</Msg>\n"
        k = rng.random() < 0.05
        add(m[: rng.randint(20, len(m) - 6)] if k else m, "mensagem", k)
        add(rng.choice(["Sem tabela de resgate", f"Ver contrato {rng.randint(1, 9999)}/2024", f"Conta {rng.randint(10000, 99999)}.10-{rng.randint(0, 9)} bloqueada até 01/02/2025"]), "OBS", False)
    return rows, cut


def test_found_texts_are_the_cut_ones(spark, scratch):
    rows, cut = corpus(random.Random(7))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id for r in truncation.judged(df, scratch).where("cortado").collect()}
    missed, extra = cut - got, got - cut
    by = {r[0]: r for r in rows}
    assert len(missed) <= 0.01 * len(cut), [by[x] for x in list(missed)[:3]]
    assert len(extra) <= 0.01 * len(cut), [by[x] for x in list(extra)[:3]]
    found = {(r.source, r.codificacao, r.limite) for r in truncation.limits(truncation.prepared(df)).collect()}
    assert ("obs", "caracteres", 255) in found and any(s == "chamado" and w == "utf8" and n == 300 for s, w, n in found)
    # notes of one length are no limit, although they are a heap
    assert not any(s == "obs" and n < 100 and w == "caracteres" for s, w, n in found)
    shares = {r.source: r for r in truncation.by_source(truncation.judged(df, scratch)).collect()}
    assert shares["mensagem"].textos == 600 and 0 < shares["mensagem"].parte < 0.15


ENDINGS = [
    ("Frase inteira.", False), ("Frase inteira.   \n\t ", False), ("Podem verificar?", False), ("Fim da frase (com nota).", False), ("Cf. correspondência, ref. contrato n.", True), ("nos termos do art.", True),
    ("confirmou a garan...", True), ("confirmou a garan…", True), ("confirmou a garan (...)", True), ("confirmou a garan [...] ", True), ("manifesta�", True), ("bloqueada (cf.", True), ("bloqueada por fulano, e a", True),
    ("<a><b>x</b></a>", False), ("<a><b>x</b>", True), ("<a><b>x.", True), ("<a>x</a>\n", False),
]


#: Texts that show which words go on behind their full stop.
TEACHERS = ["Cf. correspondência anexa, ref. contrato n. 12, item 3.", "Segue a ref. contrato n. 77, nos termos do art. 5 do manual.", "O mesmo vale (cf. item 3), nos termos do art. 6 do manual."]


def test_endings(spark, scratch):
    rows = [(i, t, f"f{i}") for i, (t, _) in enumerate(ENDINGS)] + [(1000 + i, t, "escola") for i, t in enumerate(TEACHERS)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert {r.ultima for r in truncation.going_on(truncation.prepared(df)).collect()} == {"ref", "n", "art", "cf"}
    got = {r.doc_id: r.cortado for r in truncation.judged(df, scratch).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(ENDINGS)] == ENDINGS
    assert not any(got[1000 + i] for i in range(len(TEACHERS)))


def test_general_classes_keep_lengths(spark):
    texts = ["CDB708MMNW", "CDB708MMN", "R$ 1.234.567,89", "R$ 70.315,3", "27/12/2023", "27/12/20", "conta 25496.00-2", "item 123456 e 12", "ABC"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(truncation.generalised(F.col("t")).alias("g"))
    assert [r.g for r in df.collect()] == ["xxxxxxxxxx", "xxxxxxxxx", "r$ 9,99", "r$ 9,9", "99/99/9999", "99/99/99", "conta 9+.99-9", "item 9+ e 99", "abc"]


def test_words_that_go_on_are_learned_from_different_texts(spark):
    rows = [(i, "Nada a opor ao fim. 25 itens seguem.", "f") for i in range(500)] + [(1000 + i, f"Linha {i}: chegou ao fim. Outra frase, cap. {i} do manual.", "f") for i in range(9)]
    got = truncation.going_on(truncation.prepared(spark.createDataFrame(rows, "doc_id bigint, text string, source string")))
    assert {r.ultima for r in got.collect()} == {"cap"}


def test_at_a_limit_other_sources_endings_do_not_count(spark, scratch):
    rng = random.Random(11)
    end = " fora do prazo"
    rows = [(i, sentence(rng) + "\nSegue" + end, "g") for i in range(9)] + [(100, sentence(rng) + " Segue" + end, "f")]
    body = [" ".join(sentence(rng) for _ in range(9)) for _ in range(40)]
    rows += [(200 + i, t[:255], "f") for i, t in enumerate(body)] + [(300, body[0][: 255 - len(end) - 6] + " segue" + end, "f")]
    got = {r.doc_id: r for r in truncation.judged(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), scratch).collect()}
    assert not got[100].cortado and got[300].no_limite and got[300].cortado


def test_a_cut_text_sent_again_is_no_usual_ending(spark, scratch):
    rows = [(i, "Outra frase, a de número %d." % i, "f") for i in range(20)] + [(100 + i, "A carteira apresentou posição de R$ 10", "f") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert {r.doc_id for r in truncation.judged(df, scratch).where("cortado").collect()} == {100, 101}


def test_copies_of_a_cut_text_make_no_usual_ending(spark, scratch):
    cut = "A carteira do participante apresentou posição de R$ 10"
    rows = [(i, "Outra frase, a de número %d." % i, "f") for i in range(20)] + [(100 + i, cut, "f") for i in range(30)]
    rows += [(200, "Conforme ofício, apresentou posição de R$ 25", "g"), (201, "Uma frase. Também apresentou posição de R$ 7", "h")]
    # a note of one text is known by its few words or by coming from several sources; this holds for the note alone
    rows += [(300 + i, "Sem tabela de resgate", "f") for i in range(3)] + [(310, "Esta operação segue sem tabela de resgate", "g")]
    rows += [(320 + i, "Escalonamento por período, taxa única no vencimento", "f") for i in range(3)] + [(330, "ESCALONAMENTO POR PERÍODO, TAXA ÚNICA NO VENCIMENTO", "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert {r.doc_id for r in truncation.judged(df, scratch).where("cortado").collect()} == {*range(100, 130), 200, 201, 310}


def test_copies_beside_a_limit_do_not_hide_it(spark, scratch):
    rng = random.Random(3)
    long = [" ".join(sentence(rng) for _ in range(9)) for _ in range(60)]
    rows = [(i, t[:255], "f") for i, t in enumerate(long)] + [(1000 + i, long[0][:250], "f") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {(r.codificacao, r.limite): r.textos for r in truncation.limits(truncation.prepared(df)).collect()}
    assert got["caracteres", 255] == 60 and not any(w == "caracteres" and n != 255 for w, n in got)


def test_texts_cut_at_a_transfer_block_give_no_usual_ending(spark, scratch):
    rng = random.Random(5)
    rows = [(i, sentence(rng), "f") for i in range(200)]
    for i in range(12):  # of one length each, so that no length is a heap
        n, end = 512 * (i + 1), " conforme item do manu"
        rows.append((1000 + i, (" ".join(sentence(rng) for _ in range(120)))[: n - len(end)].encode("ascii", "replace").decode() + end, "f"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert {r.bloco for r in truncation.block_limits(truncation.prepared(df)).collect()} >= {512}
    got = {r.doc_id: (r.cortado, r.no_limite) for r in truncation.judged(df, scratch).collect()}
    assert {i for i in got if got[i][0]} == {i for i in got if got[i][1]} == set(range(1000, 1012))


def test_odd_cases(spark, scratch):
    assert truncation.judged(spark.createDataFrame([], "doc_id bigint, text string, source string"), scratch).collect() == []
    rows = [(1, None, "f", 1), (2, "", "f", 1), (3, "   ", "f", 1), (4, "x." * 400_000, None, 1), (5, "Igual.", "f", 1), (6, "Igual.", "f", 1), (7, "palavra solta", "  ", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, final int")
    got = {r.doc_id: r.cortado for r in truncation.judged(df, scratch).collect()}
    assert got == {4: False, 5: False, 6: False, 7: True}
    assert {r.source: r.textos for r in truncation.by_source(truncation.judged(df, scratch)).collect()} == {"f": 2, None: 2}
