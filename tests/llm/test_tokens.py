import tiktoken

from sondar.llm import tokens


def test_counts_are_those_of_the_plain_encoder(spark):
    enc = tokens.encoding()
    texts = ["", None, "olá mundo", "  dois  espaços ", "a" * 50_000, "linha\nlinha\r\n", "😀 ½ ção", "x" + " " * 20_000 + "y", " " * 15_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.tokens for r in tokens.sized(df, "doc_id", "text", []).collect()}
    assert got == {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    for t in texts:
        assert enc.decode(tokens.encode(enc, t)) == (t or "")
    assert isinstance(enc, tiktoken.Encoding)


def test_very_long_runs_of_blanks_do_not_break_off(spark):
    enc = tokens.encoding()
    t = "a" + " " * 1_500_000 + "b" + "\n" * 300_000
    assert enc.decode(tokens.encode(enc, t)) == t
