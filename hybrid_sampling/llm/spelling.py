"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words the shorter one (either, if they are as long) contributes two disjoint
chunks, its halves; the other one its positional grams. A single edit touches one
half at most, so the other half stands in the longer word as a gram, shifted by the
difference of the lengths, nought or one. The rest of both words holds the edit and is again
within one edit, so the rule applies to it once more: the rest is halved, and one of these
chunks is preserved, too. The key of the join is both preserved chunks with the
length of the shorter word (its places follow from that), so at most about a quarter of a
word is free within a key and no key grows with the corpus beyond the letters' own
combinations. Grams that no chunk of the other word could meet are not sent. Each match is
verified by its edit distance, and a pair met under several keys counts once.

A word's form is its near word of largest count, if that count is ``ratio`` times
its own; forms lead to a root by pointer jumping, each round a written table (counts grow by the
ratio from word to form, so rounds grow with the logarithm of a logarithm).

Defined cases: a null text has no words; an empty text neither; a null id counts as an
empty string in the damage; repeated rows count again; ties of counts go to the smallest
word by code point; an empty table gives no rows; a very long text is cut into words within
its row, so it takes memory in proportion to itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Letters of a word: A-Z, a-z and the Latin-1 code points from U+00C0 on.
LETTERS = r"[A-Za-zÀ-ÿ]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(word: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row (id, run) for every maximal run of letters of every whole text."""
    rows = docs.select(docs[id_col].alias("id"), F.explode(F.regexp_extract_all(docs[text_col], F.lit(LETTERS), F.lit(0))).alias("run"))
    return rows.select("id", ascii_lower(F.col("run")).alias("run"))


def damaged(rows: DataFrame, share: int = 97) -> DataFrame:
    """``rows`` with a column ``word``: one run in ``share`` loses a letter, both told by the checksum of ``id:run``."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(F.col("_h"), F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return rows.withColumn("_h", h).withColumn("word", F.when(F.col("_h") % share == 0, cut).otherwise(F.col("run"))).drop("_h")


def vocabulary(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n) of the words of at least that length and count; counted where the rows are before any shuffle."""
    counts = words.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least_count)


def _keys(words: DataFrame, longer: int) -> DataFrame:
    """Four rows (key, word, n, longer) a word: what it shares with a word shorter by ``longer`` for each piece that may hold the edit."""
    length = F.char_length("word") - longer
    half = F.floor(length / 2)
    quarter, rest = F.floor(half / 2), half + F.floor((length - half) / 2)
    # the pieces end at quarter, half, rest and length; a key has what stands before one piece and what stands after it
    free = [(F.lit(0), quarter), (quarter, half), (half, rest), (rest, length)]
    keys = [
        F.xxhash64(F.lit(i), length, F.substring("word", F.lit(1), a.cast("int")), F.substring("word", (b + longer + 1).cast("int"), length.cast("int")))
        for i, (a, b) in enumerate(free)
    ]
    return words.select(F.explode(F.array(*keys)).alias("key"), "word", "n", F.lit(longer).alias("longer"))


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(u, u_n, v, v_n): every pair of words that differ by exactly one inserted, deleted or replaced code point, once."""
    chunks = _keys(vocab, 0).select("key", F.col("word").alias("u"), F.col("n").alias("u_n"))
    grams = _keys(vocab, 0).unionByName(_keys(vocab, 1)).select("key", "longer", F.col("word").alias("v"), F.col("n").alias("v_n"))
    met = chunks.join(grams, "key").filter(((F.col("longer") == 1) | (F.col("u") < F.col("v"))) & (F.levenshtein("u", "v", 1) == 1))
    return met.select("u", "u_n", "v", "v_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row (word, form): the end of the chain of forms. Chains have no circles."""
    up = stage(forms.select("word", F.col("form").alias("root")), "spelling-up")
    while True:
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = stage(up.join(nxt, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_on")), "spelling-up")
        if step.filter("_on").isEmpty():
            return step.select("word", "root")
        up = step.select("word", "root")


def spelling_groups(vocab: DataFrame, ratio: int = 2) -> DataFrame:
    """Every word of ``vocab`` (word, n) with form, root, n_near and form_n."""
    vocab = stage(vocab, "spelling-words")
    pairs = near_pairs(vocab)
    both = pairs.select(F.col("u").alias("word"), "v", "v_n").unionByName(pairs.select(F.col("v").alias("word"), F.col("u").alias("v"), F.col("u_n").alias("v_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("v_n")).alias("less"), F.col("v").alias("form"))).alias("b"))
    taken = -F.col("b.less") >= ratio * F.col("n")
    near = vocab.join(best, "word", "left").select(
        "word", F.when(taken, F.col("b.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, -F.col("b.less")).alias("form_n")
    )
    near = stage(near, "spelling-forms")
    out = near.join(roots(near.filter("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
