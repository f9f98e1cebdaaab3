"""URL filters: association rules over URL tokens, mined by FP-growth from labels.

The tokens of a labelled URL (host suffixes, host words, path words, query keys,
fragment) and, for a bad label, one label item are a transaction. Spark's FP-growth gives the frequent
combinations; rules with the label as consequent stay if they meet the support
(``min_support`` of all transactions and ``min_count`` of them) and the confidence, and if no part of their antecedent does as well. URLs are
matched by an inverted index from token to rules: a rule fires when all of its
tokens have been counted.

Mining is on labelled rows only, with all tokens that stand in enough bad rows for a
rule; no transaction is cut. Tokens that stand in the very same labelled rows are one item while mining, and
a rule with that item becomes one with each of them, so what always comes together does not multiply the sets. Sets and their counts
stay distributed until only the rules that no part of theirs matches are left; their number (and FP-growth's
work) grows with the sets that are frequent. Matching takes all tokens of all URLs.

Listed (host, path) rules come first: a rule fits its host and all subdomains if
the path starts with the rule's; of several the longest wins.

Defined cases: a null URL, or one without "://", has an empty host and path, fits
no listed rule and no mined rule; null labels are left out; an id labelled more
than once takes its worst label; without bad labels no rule is mined; repeated
rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import product

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

_LABEL = "=bad"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; null or no :// gives an empty one."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host words and suffixes, path words (digits as one token), keys of the query, scheme."""
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    suffixes = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat(F.lit("s:"), F.array_join(F.slice(labels, i, n), ".")))).otherwise(F.array().cast("array<string>"))
    words = F.filter(F.split(F.regexp_replace(F.lower(path), r"\d+", "0"), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(rest, "&"), lambda x: F.split(x, "=")[0]), lambda x: x != "")
    mark = F.when(F.coalesce(url, F.lit("")).contains("#"), F.array(F.lit("f:#"))).otherwise(F.array().cast("array<string>"))
    parts = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)), suffixes,
        F.transform(words, lambda x: F.concat(F.lit("p:"), x)),
        F.transform(keys, lambda x: F.concat(F.lit("q:"), x)), mark,
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(parts))


def mine_rules(pages: DataFrame, labels: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6, min_count: int = 20) -> list[tuple[tuple[str, ...], float, float]]:
    """(tokens, confidence, support) of every rule kept. pages (id, url), labels (id, bad boolean)."""
    bad = labels.dropna().groupBy("id").agg(F.max("bad").alias("bad"))
    tokens = pages.select("id", tokens_of(F.col("url")).alias("items")).join(bad, "id").filter(F.size("items") > 0)
    known = stage(tokens.select("bad", "items", F.monotonically_increasing_id().alias("k")), "url-labelled")  # numbered as written
    total = known.agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad")).first()
    if not total.bad:
        return []
    least = math.ceil(max(min_support * total.n, min(min_count, total.n)))  # bad rows of a rule
    baskets, members = _baskets(known, least)
    rows = baskets.count()
    if not rows:
        return []
    kept = _unmatched(_sets(baskets, (least - 0.5) / rows, min_confidence))
    out = []
    for r in kept.collect():  # the rules themselves
        for choice in product(*(members[t] for t in r.tokens)):
            out.append((tuple(sorted(choice)), r.both / r.freq, r.both / total.n))
    return sorted(out, key=lambda r: (len(r[0]), r[0]))


def _baskets(known: DataFrame, least: int) -> tuple[DataFrame, dict[str, list[str]]]:
    """Transactions (items, bad) of the tokens in ``least`` bad rows or more, one item for all tokens that stand in the very
    same rows (told by their number and two sums of row hashes), and the tokens of each item."""
    seen = known.select("bad", "k", F.explode("items").alias("token"))
    same = [F.count_if("bad").alias("b"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("k")).alias("x"), F.bit_xor(F.xxhash64("k", F.lit(1))).alias("y")]
    frequent = stage(seen.groupBy("token").agg(*same).filter(F.col("b") >= least), "url-tokens")  # tokens of a URL / min_support at most
    item = F.min("token").over(Window.partitionBy("b", "n", "x", "y"))
    items = frequent.select("token", item.alias("item"))
    members: dict[str, list[str]] = defaultdict(list)
    for r in items.collect():
        members[r.item].append(r.token)
    heads = items.filter("token = item").select("token")
    return stage(seen.join(heads, "token").groupBy("k", "bad").agg(F.collect_list("token").alias("items")).drop("k"), "url-baskets"), members


def _sets(baskets: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """(tokens, both, freq, rule) of all sets that are frequent in bad rows, by FP-growth; ``rule``: the confidence, where it is enough."""
    marked = baskets.select(F.concat("items", F.when(F.col("bad"), F.array(F.lit(_LABEL))).otherwise(F.array().cast("array<string>"))).alias("items"))
    sets = stage(FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(marked).freqItemsets, "url-sets")
    whole = sets.filter(F.array_contains("items", _LABEL)).select(F.sort_array(F.array_except("items", F.array(F.lit(_LABEL)))).alias("tokens"), F.col("freq").alias("both"))
    alone = sets.filter(~F.array_contains("items", _LABEL)).select(F.sort_array("items").alias("tokens"), "freq")
    confidence = F.col("both") / F.col("freq")
    return stage(whole.join(alone, "tokens").withColumn("rule", F.when(confidence >= min_confidence, confidence)), "url-confidence")


def _unmatched(sets: DataFrame) -> DataFrame:
    """The rules of which no part does as well. All parts of a frequent set are frequent, so the best confidence among
    a set's parts comes from those one token smaller, size by size."""
    if sets.filter("rule IS NOT NULL").isEmpty():
        return sets.limit(0)
    sizes = sets.agg(F.max(F.size("tokens"))).first()[0]
    kept = below = None
    for k in range(1, sizes + 1):
        own = sets.filter(F.size("tokens") == k)
        if below is None:
            told = own.withColumn("part", F.lit(None).cast("double"))
        else:
            parts = own.select("tokens", F.explode(F.transform("tokens", lambda t: F.array_except("tokens", F.array(t)))).alias("less"))
            best = parts.join(below, "less").groupBy("tokens").agg(F.max("best").alias("part"))
            told = own.join(best, "tokens", "left")
        told = stage(told, "url-parts")
        rules = told.filter(F.col("rule").isNotNull() & (F.col("part").isNull() | (F.col("rule") > F.col("part")))).select("tokens", "both", "freq")
        kept = rules if kept is None else kept.unionByName(rules)
        below = told.select(F.col("tokens").alias("less"), F.greatest("rule", "part").alias("best"))
    return kept


def fired(rows: DataFrame, rules: list[tuple[tuple[str, ...], float, float]]) -> Column:
    """The number of the best mined rule (by confidence, then by order) whose tokens all stand in ``tokens``; else null."""
    index: dict[str, list[int]] = defaultdict(list)
    order = sorted(rules, key=lambda r: (-r[1], r[0]))
    for k, (items, *_) in enumerate(order):
        for item in items:
            index[item].append(k)
    shared = rows.sparkSession.sparkContext.broadcast((dict(index), [len(r[0]) for r in order], [" & ".join(r[0]) for r in order]))

    @F.pandas_udf("string")
    def first(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, sizes, names = shared.value
        for part in parts:
            out = []
            for tokens in part:
                counts: dict[int, int] = defaultdict(int)
                for t in tokens:
                    for k in index.get(t, ()):
                        counts[k] += 1
                whole = [k for k, n in counts.items() if n == sizes[k]]
                out.append(names[min(whole)] if whole else None)
            yield pd.Series(out, dtype=object)

    return first("tokens")


def judge(pages: DataFrame, listed: list[tuple[str, str, str]], rules: list[tuple[tuple[str, ...], float, float]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (listed), verdict, mined (the tokens of the mined rule).

    listed: (allow or block, host, path), a short list of the caller's.
    """
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"))
    rows = rows.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), tokens_of(F.col("url")).alias("tokens"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, host, path in sorted(listed, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(verdict)
    rows = rows.select("id", "host", "path", rule.alias("rule"), verdict.alias("listed"), fired(rows, rules).alias("mined"))
    method = F.when(F.col("mined").isNotNull(), "block").otherwise("allow")
    return rows.select("id", "host", "path", "rule", F.coalesce("listed", method).alias("verdict"), "mined")
