"""Text cut off by field limits (problem 8): lengths under alternative encodings, then endings.

A field limit shows as a heap of texts of one length, if the length is counted as the field's system counted it: in
characters, bytes, after entity or JSON escaping, or with newlines as two signs. Lengths are recomputed in all of these
and grouped by each; heaps of lengths, and heaps at multiples of a transfer block, are limits. Texts away from all limits
show how each source's texts usually end. A text at a limit is cut unless it ends in a sentence or as its own source's
texts do; away from limits, where only a transfer can have cut it, endings known from other sources and known notes clear
it too. What is no end of a sentence in spite of its full stop is learned from all texts: words after which they go on.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import BLANKS, filled
from ..operators.scratch import Scratch
from ..operators.skew import sized_join

#: Transfer blocks, in bytes (fixed values).
BLOCKS = (512, 1024, 4096)
#: Trailing blanks of any kind (fixed values).
OUTER = BLANKS + "\u00a0\u0085\u2007\u202f\u2028\u2029\u3000"
#: Signs that stand for what is missing: an ellipsis, bracketed or not, and the sign of a character that could not be read (fixed values).
MARKS = r"([.]{2,}|\x{2026}|\x{FFFD})[)\]]?$"
#: A short word, looked for backwards from a full stop.
BEFORE = r"(?<=(?<![\p{L}\p{N}.])(\p{L}[\p{L}.\x{BA}]{0,5})[.])"
#: Full stops behind which a text goes on, those behind which a sentence may begin, and the last one.
GOES_ON, STARTS, LAST = r"[.](?=[,;:]|\s+[\p{Ll}\p{Nd}])" + BEFORE, r"[.](?=\s+[^\s\p{Ll}\p{Nd}])" + BEFORE, r"[.]$" + BEFORE


@dataclass(frozen=True)
class TruncationConfig:
    """heap: a length is a limit if so many times as many texts have it as the lengths around it have at most, and it has at least ``least`` texts and ``share`` of the source's.

    usual: an ending is usual in its source from this share of its different texts on (and from two different texts on).
    note: a note that is a single text is known as such if it came so often or more, beside its other signs.
    goes_on: a word is known to go on behind its full stop if, in so many different texts or more, no sentence begins
    there at least as often as one does; or, seen in ``often`` texts or more, if it ends a text at most ``ends`` as often.
    """

    heap: float = 4.0
    least: int = 5
    share: float = 0.003
    around: int = 8
    usual: float = 0.001
    note: int = 3
    goes_on: int = 2
    often: int = 100
    ends: float = 0.005


def _count(text: Column, *signs: str) -> Column:
    """How often these ASCII signs occur in the text."""
    n = F.lit(0)
    for sign in signs:
        n = n + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))
    return n


def lengths(text: Column) -> dict[str, Column]:
    """The text's length under each way of counting it: from a few counts of signs and the part beyond ASCII, in the JVM."""
    chars, utf8 = F.length(text), F.octet_length(text)
    # one pass over the text; all that any way of counting treats as special is left, and is short
    odd = F.regexp_replace(text, r"""[ !#-%(-;=?-\[\]-~\x00-\x07\x0B\x0E-\x1F\x7F]+""", "")
    beyond = F.regexp_replace(odd, r"[\x00-\x7F]+", "")
    plain = F.length(beyond)
    far = F.length(F.regexp_replace(beyond, r"[\x{80}-\x{3E7}]+", ""))  # of these, those whose decimal number has four digits or more
    five = F.length(F.regexp_replace(beyond, r"[\x{80}-\x{270F}]+", ""))
    six = F.length(F.regexp_replace(beyond, r"[\x{80}-\x{1869F}]+", ""))
    astral = F.length(F.regexp_replace(beyond, r"[\x{80}-\x{FFFF}]+", ""))
    newlines, quote = _count(odd, "\n"), _count(odd, '"')
    xml = 4 * _count(odd, "&") + 3 * _count(odd, "<", ">") + 5 * quote + 4 * _count(odd, "'")
    entity = 5 * plain + far + five + six  # &#233; and longer ones
    json = newlines + quote + _count(odd, "\\", "\t", "\r", "\x08", "\x0c")
    return {
        "caracteres": chars,
        "utf8": utf8,
        "utf16": chars + astral,
        "crlf": chars + newlines,
        "crlf_utf8": utf8 + newlines,
        "xml": chars + xml,
        "xml_utf8": utf8 + xml,
        "entidades": chars + entity,
        "xml_entidades": chars + xml + entity,
        "json": chars + json,
        "json_utf8": utf8 + json,
        "json_ascii": chars + json + 5 * plain + 6 * astral,
    }


def prepared(documents: DataFrame) -> DataFrame:
    """doc_id, source (lower case, no outer blanks, '' if empty), ending columns and lengths of every text that isn't empty. No shuffle; the texts stay behind."""
    text = F.col("text")
    base = documents.select("doc_id", F.coalesce(F.lower(filled(F.col("source"))), F.lit("")).alias("source"), "text").where(filled(text).isNotNull())
    kept = base.withColumn("__end", F.rtrim(text, F.lit(OUTER))).withColumn("brancos", F.length(text) - F.length("__end"))
    for name, c in steps().items():  # each computed once
        kept = kept.withColumn(name, c)
    sizes = F.struct(*(v.cast("int").alias(k) for k, v in lengths(text).items())).alias("tamanhos")
    return kept.select("doc_id", "source", sizes, "brancos", F.xxhash64("__end").alias("impressao"), *(c.alias(k) for k, c in endings().items()))


def generalised(text: Column) -> Column:
    """Lower case, with figures and codes in general classes that keep their lengths, so that a part of one is not taken for a whole one.

    Whole parts of decimal numbers are 9; digits are 9 each, from five in a row on 9+; letters and digits mixed in a word
    are x each.
    """
    t = F.lower(text)
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}.])\p{Nd}{1,3}(?:[.]\p{Nd}{3})*(?=,\p{Nd})", "9")
    x = F.regexp_replace(t, r"\p{L}(?:(?=\p{L}*\p{Nd})|(?<=\p{Nd}\p{L}{1,21}))", "x")
    x = F.regexp_replace(x, r"\p{Nd}(?:(?=\p{Nd}*x)|(?<=x\p{Nd}{1,21}))", "x")
    t = F.when(t.rlike(r"\p{L}\p{Nd}|\p{Nd}\p{L}"), x).otherwise(t)
    return F.regexp_replace(F.regexp_replace(t, r"\p{Nd}{5,}", "9+"), r"\p{Nd}", "9")


def steps() -> dict[str, Column]:
    """What the endings are read from, each from the one before: the last line, what follows the last end of a sentence in it, that generalised."""
    return {
        "__line": F.substring_index("__end", "\n", -1),
        "__segment": F.ltrim(F.regexp_replace("__line", r"(?s)^.*[.!?]\s+(?=[\p{Lu}(\[<\xBF\xA1])", ""), F.lit(BLANKS)),
        "__general": generalised(F.col("__segment")),
        "__tail": F.regexp_replace("__general", r"(?s)^.*\s(?=\S+\s+\S+\s+\S+\s+\S+$)", ""),
        "__start": F.ltrim("__end", F.lit(BLANKS)),
    }


def endings() -> dict[str, Column]:
    """What a text without trailing blanks ends in.

    marca: a sign that stands for what is missing; fecho: a full stop, question or exclamation mark, but not inside an open
    bracket or a tag; ultima: the short word before a full stop at the end, '' if there is none; raiz: the closing tag of
    the root element; final: the last four words of what follows the last end of a sentence or line, generalised; nota: a
    hash of the whole text in this form, NULL if a sentence or line comes before its last one; curta: whether such a text
    is no longer than ``final``; classe: one of 64 classes of ``final``; seguem: the short words with a full
    stop inside the text, k = 1 where it goes on behind them with a comma, a figure or a small letter, else 0.
    """
    end, line, t, tail, start = (F.col(c) for c in ("__end", "__line", "__general", "__tail", "__start"))
    last = F.substring(line, -12, 12)  # all that the patterns of an end can reach
    # a bracket opened in the last line and not closed
    open_ = F.octet_length(F.replace(line, F.lit("("), F.lit(""))) < F.octet_length(F.replace(line, F.lit(")"), F.lit("")))
    markup = F.startswith(start, F.lit("<"))
    alone = F.col("__segment") == start
    root = F.when(markup, F.regexp_extract(start, r"^<([\p{L}_][^\s>/]*)", 1))
    words = lambda pattern, k: F.transform(F.array_distinct(F.regexp_extract_all(end, F.lit(pattern), F.lit(1))), lambda w: F.struct(F.lower(w).alias("palavra"), F.lit(k).alias("k")))
    return {
        "marca": last.rlike(MARKS),
        "fecho": last.rlike(r"[.!?][\"'\x{201D}\xBB)]?$") & ~last.rlike(MARKS) & ~open_ & ~markup,
        "ultima": F.lower(F.regexp_extract(last, LAST, 1)),
        "marcado": markup,
        "raiz": F.coalesce((root != "") & F.endswith(end, F.concat(F.lit("</"), root, F.lit(">"))), F.lit(False)),
        "final": tail,
        "nota": F.when(alone, F.xxhash64(t)),
        "curta": alone & (tail == t),
        "classe": F.pmod(F.xxhash64(tail), F.lit(64)).cast("int"),
        "seguem": F.concat(words(STARTS, 0), words(GOES_ON, 1)),
    }


def going_on(docs: DataFrame, config: TruncationConfig = TruncationConfig()) -> DataFrame:
    """ultima: short words after whose full stop texts go on (abbreviations), learned from all different texts of all sources."""
    inside = docs.select("impressao", F.explode("seguem").alias("__s")).select("impressao", F.col("__s.palavra").alias("ultima"), "__s.k")
    at_end = docs.where(F.col("fecho") & (F.col("ultima") != "")).select("impressao", "ultima", F.lit(2).alias("k"))
    once = inside.unionByName(at_end).groupBy("ultima", "k", "impressao").agg(F.lit(1).alias("__one"))
    n = once.groupBy("ultima").agg(*(F.count_if(F.col("k") == k).alias(name) for k, name in enumerate(("up", "go", "end"))))
    seen = F.col("go") + F.col("up")
    known = ((F.col("go") >= config.goes_on) & (F.col("go") >= F.col("up"))) | ((seen >= config.often) & (F.col("end") <= config.ends * seen))
    return n.where(known).select("ultima")


def _exploded(docs: DataFrame, ways: list[str]) -> DataFrame:
    """source, codificacao, n, k (different texts of that length), finais: into how many of 64 classes their endings fall.

    Copies of a text count once, also if other blanks behind it give them other lengths in some way of counting.
    """
    bit = F.expr("shiftleft(1L, classe)")
    texts = docs.groupBy("source", "impressao", bit.alias("__b")).agg(F.collect_set("tamanhos").alias("__sizes"))
    each = F.flatten(F.array(*(F.transform(F.array_distinct(F.transform("__sizes", lambda x: x[w])), lambda n: F.struct(F.lit(w).alias("codificacao"), n.alias("n"))) for w in ways)))  # noqa: B023 - called at once
    long = texts.select("source", "__b", F.explode(each).alias("__e")).select("source", "__b", "__e.codificacao", "__e.n")
    return long.groupBy("source", "codificacao", "n").agg(F.count(F.lit(1)).alias("k"), F.bit_count(F.bit_or("__b")).alias("finais"))


def limits(docs: DataFrame, config: TruncationConfig = TruncationConfig()) -> DataFrame:
    """source, codificacao, limite, textos, vizinhos: the heaps of lengths, per source and way of counting.

    Every source's lengths are counted under every way; a text counts once, however often it was sent, in textos and
    vizinhos too. A heap stands out ``heap`` times
    over the lengths within ``around`` of it. Counting in the field's own way heaps the texts on one length; any other
    way smears them, so the sharpest way of each limit tells how the field counts. A limit in bytes may heap a few bytes
    lower, where a sign would be split; texts there end like cut ones and are found by that. Texts cut at a limit end in
    all manner of ways: a heap of texts that end alike is a note of fixed length, and no limit.
    """
    counts = _exploded(docs, list(docs.schema["tamanhos"].dataType.names))
    near = Window.partitionBy("source", "codificacao").orderBy("n").rangeBetween(-config.around, -1)
    after = Window.partitionBy("source", "codificacao").orderBy("n").rangeBetween(1, config.around)
    total = Window.partitionBy("source", "codificacao")
    c = counts.withColumn("__near", F.greatest(F.coalesce(F.max("k").over(near), F.lit(0)), F.coalesce(F.max("k").over(after), F.lit(0)))).withColumn("__all", F.sum("k").over(total))
    heap = (F.col("k") >= config.least) & (F.col("k") >= config.share * F.col("__all")) & (F.col("k") >= config.heap * F.greatest(F.col("__near"), F.lit(1)))
    heap = heap & (F.col("finais") >= F.greatest(F.lit(3), F.least(F.col("k"), F.lit(64)) / 4))
    return c.where(heap).select("source", "codificacao", F.col("n").alias("limite"), F.col("k").alias("textos"), F.col("__near").alias("vizinhos"))


def histogram(docs: DataFrame) -> DataFrame:
    """source, codificacao, n, textos: how many different texts of each source have each length, in every way of counting it."""
    return _exploded(docs, list(docs.schema["tamanhos"].dataType.names)).select("source", "codificacao", "n", F.col("k").alias("textos"))


def block_limits(docs: DataFrame, config: TruncationConfig = TruncationConfig()) -> DataFrame:
    """source, codificacao, bloco, textos (different ones), esperados: lengths in bytes that are multiples of a transfer block more often than chance."""
    ways = ["utf8", "crlf_utf8", "caracteres"]
    counts = _exploded(docs, ways)
    parts = []
    for b in BLOCKS:
        per = counts.where(F.col("n") >= b).groupBy("source", "codificacao").agg(F.sum(F.when(F.col("n") % b == 0, F.col("k")).otherwise(0)).alias("textos"), (F.sum("k") / F.lit(b)).alias("esperados"))
        parts.append(per.where((F.col("textos") >= config.least) & (F.col("textos") >= config.heap * F.col("esperados"))).select("source", "codificacao", F.lit(b).alias("bloco"), "textos", "esperados"))
    return reduce(DataFrame.unionByName, parts)


def at_limit(docs: DataFrame, found: DataFrame, blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with no_limite: whether the text's length, counted in some way, is a limit of its source or a multiple of a transfer block that shows there, and the text, not blanks, fills it.

    ``found`` (as of ``limits``) has at most 1 / share rows a source and way, ``blocks`` (as of ``block_limits``) at most
    three; what they come to is counted before it is broadcast.
    """
    at = F.struct("codificacao", F.col("n").cast("int").alias("n"))
    both = found.select("source", "codificacao", F.col("limite").alias("n"), F.lit(False).alias("__block")).unionByName(blocks.select("source", "codificacao", F.col("bloco").alias("n"), F.lit(True).alias("__block")))
    per = both.groupBy("source").agg(F.collect_set(F.when(~F.col("__block"), at)).alias("__limits"), F.collect_set(F.when(F.col("__block"), at)).alias("__blocks"))
    ways = list(docs.schema["tamanhos"].dataType.names)
    mine = F.array(*(F.struct(F.lit(w).alias("codificacao"), F.col(f"tamanhos.{w}").alias("n")) for w in ways))
    joined = sized_join(docs, per, ["source"], "left", ["doc_id"], scratch)
    block = F.exists("__blocks", lambda b: F.exists(mine, lambda m: (m["codificacao"] == b["codificacao"]) & (m["n"] > 0) & (m["n"] % b["n"] == 0)))
    filled_ = F.coalesce(F.arrays_overlap(mine, F.col("__limits")), F.lit(False)) | F.coalesce(block, F.lit(False))
    return joined.withColumn("no_limite", filled_ & (F.col("brancos") <= 1)).drop("__limits", "__blocks")


def _free(docs: DataFrame) -> DataFrame:
    """source, final, nota, curta, impressao, copias of the different texts that are at no limit, carry no mark and end neither in a sentence nor at a comma or a word that goes on."""
    free = docs.where(~F.col("no_limite") & ~F.col("marca") & ~F.col("frase") & ~F.col("marcado") & ~F.col("final").rlike("[.,;:(]$"))
    return free.groupBy("source", "final", "nota", "curta", "impressao").agg(F.count(F.lit(1)).alias("copias"))


def usual_endings(docs: DataFrame, config: TruncationConfig = TruncationConfig()) -> DataFrame:
    """source, final, textos (different ones): how a source's texts end that are at no limit, carry no mark and end in no sentence: closings, signatures, short notes.

    Usual is what several different texts end in: a cut text is no usual ending, however often it was sent. What stops
    at a comma or a full stop is never usual. Endings usual in some source, with three different texts or
    more, hold for texts of any source too (source '*'): a small source shows few of its own, an empty one none.
    """
    per = _free(docs).groupBy("source", "final").agg(F.count(F.lit(1)).alias("textos"))
    size = docs.groupBy("source", "impressao").agg(F.lit(1).alias("__one")).groupBy("source").agg(F.count(F.lit(1)).alias("__all"))
    common = per.where(F.col("source") != "").join(size, "source").where((F.col("textos") >= 2) & (F.col("textos") >= config.usual * F.col("__all"))).select("source", "final", "textos")
    anywhere = common.where(F.col("textos") >= 3).groupBy("final").agg(F.sum("textos").alias("textos")).select(F.lit("*").alias("source"), "final", "textos")
    return common.unionByName(anywhere)


def notes(docs: DataFrame, config: TruncationConfig = TruncationConfig()) -> DataFrame:
    """nota: whole texts without a sentence that came ``note`` times or more in a source and either came from several sources or are four words at most.

    The ending of such a note may be seen in no other text. It holds for this text alone, not for others that end alike.
    A text of so few words that was cut, and sent so often, looks the same and passes for a note.
    """
    per = _free(docs).where((F.col("source") != "") & F.col("nota").isNotNull()).groupBy("source", "nota").agg(F.sum("copias").alias("__n"), F.max("curta").alias("curta"))
    each = per.groupBy("nota").agg(F.max("__n").alias("__most"), F.count(F.lit(1)).alias("__in"), F.max("curta").alias("curta"))
    return each.where((F.col("__most") >= config.note) & (F.col("curta") | (F.col("__in") >= 2))).select("nota")


def judged(documents: DataFrame, scratch: Scratch, config: TruncationConfig = TruncationConfig()) -> DataFrame:
    """doc_id, source, cortado, no_limite, marca of every text that isn't empty.

    cortado: the text carries a mark of a break, or ends neither with its root's closing tag, nor in a sentence, nor in a
    way usual for its source; away from all limits, a way usual in other sources or a known note will do as well. Empty
    texts are no cases and are left out; trailing blanks mean nothing. The same text under two ids is two texts. No
    documents, no rows.
    """
    docs = scratch.keep(prepared(documents))
    words = going_on(docs, config).withColumn("__goes_on", F.lit(True))
    placed = at_limit(docs.drop("seguem"), limits(docs, config), block_limits(docs, config), scratch)
    placed = sized_join(placed, words, ["ultima"], "left", ["doc_id"], scratch)
    docs = scratch.keep(placed.withColumn("frase", F.col("fecho") & F.col("__goes_on").isNull()).drop("__goes_on", "fecho", "tamanhos"))
    usual = scratch.keep(usual_endings(docs, config))
    # one row an ending: the sources in which it is usual
    usual = usual.groupBy("final").agg(F.collect_set("source").alias("__in"))
    joined = sized_join(docs, usual, ["final"], "left", ["doc_id"], scratch)
    joined = sized_join(joined, notes(docs, config).withColumn("__note", F.lit(True)), ["nota"], "left", ["doc_id"], scratch)
    here = F.coalesce(F.array_contains("__in", F.col("source")), F.lit(False))
    elsewhere = F.coalesce(F.array_contains("__in", "*"), F.lit(False)) | F.coalesce("__note", F.lit(False))
    whole = F.when(F.col("marcado"), F.col("raiz")).otherwise(F.col("frase") | here | (~F.col("no_limite") & elsewhere))
    return joined.select("doc_id", "source", (F.col("marca") | ~whole).alias("cortado"), "no_limite", "marca")


def by_source(judged_: DataFrame) -> DataFrame:
    """source (NULL if empty), textos, cortados, parte, no_limite: how often each source's texts break off."""
    return judged_.groupBy(F.when(F.col("source") != "", F.col("source")).alias("source")).agg(F.count(F.lit(1)).alias("textos"), F.count_if("cortado").alias("cortados"), F.round(F.count_if("cortado") / F.count(F.lit(1)), 6).alias("parte"), F.count_if("no_limite").alias("no_limite"))
