"""Benchmark decontamination with DataFrame functions only.

An item contaminates a document if some window of the document with as many words as the item has a weighted-shingle
similarity of SIMILARITY or more with it: over shingles of five words in lower case, each weighted by how often it
occurs, the sum of the smaller weights over the sum of the larger.

1. Windows. With m shingles in the item and as many in the window, a similarity of 0.8 takes 8 m / 9 shared ones or
   more. So a window goes on if at least so many of its shingles are some item's of that length, in whatever order
   they stand; others can't reach the similarity. A document shorter than the item is one window. A window is in place
   if it starts at a shared shingle's position less its offset in the item, moved into the document where it sticks
   out. A passage found in place also shows in windows a few words off; these count only for pairs of document and
   item that have no window in place, such as items whose parts were reordered.
2. Fingerprints. Each window's and each item's 64-bit SimHash is the majority of each bit over its shingles' hashes.
3. Candidates. The fingerprint is cut into RADIUS + 1 blocks, so fingerprints within RADIUS bits agree in one block at
   least. At a similarity of 0.8 two fingerprints differ in about 10 bits with a spread of 3, and the radius has to be
   far above that, which leaves blocks of three bits. These alone would pair most windows with most items of a length, so the
   index is kept for each rare shingle: of the shingles in order from those of the fewest items to those of the most, the
   first that more than the rest of a similar text's shingles can't do without. Texts of a similarity of 0.8 share
   one of these, so a join on (words of the item, rare shingle, block, value) misses no pair within the radius, and its
   output follows what texts share instead of what there is. The distance is then counted.
4. Verification. For candidates, the similarity is computed exactly from the shingles' counts.

Items are the small side. Their shingles, counted first, are broadcast in slices of BROADCAST_ROWS, for each of which the
documents are looked through once, so that no word of the corpus is shuffled and a shingle that very many documents hold is
no hot key; beyond MOST_SLICES slices Spark joins by shuffling. Each task gathers a document's positions before it shuffles. The texts are read a second time for those documents that have a
window: their text hashes, counted first, are broadcast like the items, so that only those texts are shuffled.

Items with fewer than five words are one shingle of all their words; documents then have shingles of that many words
too. Null texts and texts without words hold nothing, as items and as documents. A null doc_id is a document of its own text.
Repeated rows count once. Empty tables give an empty result. Only doc_id and text, item_id and text are read.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import GAP, counted, staged, text_of, unused

SHINGLE, SIMILARITY, BITS, RADIUS = 5, 0.8, 64, 20
BROADCAST_ROWS, MOST_SLICES = 2_000_000, 8


def words(text: Column) -> Column:
    """The words of a text in lower case; none for a null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def shingles(hashes: Column, k: int) -> Column:
    """Hashes of k words in a row, from the words' hashes; none if there are fewer words."""
    n = F.size(hashes)
    at = lambda i: F.xxhash64(*(F.element_at(hashes, i + j) for j in range(k)))
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - F.lit(k - 1)), at)).otherwise(F.array().cast("array<bigint>"))


def fingerprint(hashes: Column) -> Column:
    """The SimHash of an array of hashes: a bit is 1 if more than half of the hashes have it."""
    n = F.size(hashes)
    ones = lambda b: F.aggregate(hashes, F.lit(0), lambda s, h: s + F.getbit(h, b).cast("int"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("bigint"), lambda f, b: f.bitwiseOR(F.when(ones(b) * 2 > n, F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))))


def blocks(fp: Column, n: int = RADIUS + 1) -> Column:
    """The fingerprint cut into n blocks of nearly equal width: structs of block and value."""
    cuts = [BITS * k // n for k in range(n + 1)]
    return F.array(*(F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(F.shiftleft(fp, BITS - b), BITS - b + a).alias("value")) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))))


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, k, n (words), shingles and fp of each item that has words."""
    own = text_of(benchmark, "item_id", "text").distinct().select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    hashed = own.select("item_id", F.size("words").alias("n"), F.least(F.size("words"), F.lit(SHINGLE)).alias("k"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    by_k = F.coalesce(*(F.when(F.col("k") == k, shingles(F.col("h"), k)) for k in range(1, SHINGLE + 1)))
    found = hashed.select("item_id", "n", "k", by_k.alias("shingles"))
    return found.select("item_id", "n", "k", "shingles", fingerprint(F.col("shingles")).alias("fp"))


def counted_tokens(hashes: Column) -> Column:
    """An array as a set of as many members: of equal hashes the second and later ones are told apart by their number."""

    def numbered(all_of: Column) -> Column:
        nth = lambda x, i: i + F.lit(1) - F.array_position(all_of, x)
        return F.transform(all_of, lambda x, i: F.when(nth(x, i) == 0, x).otherwise(F.xxhash64(x, nth(x, i))))

    return F.transform(F.array(F.array_sort(hashes)), numbered)[0]  # binds the sorted array


def rare_shingles(table: DataFrame, key: str, shared: DataFrame, need: Column) -> DataFrame:
    """key, n, fp and each rare shingle of a table with these and shingles: the first size - need + 1 in order of the number of
    items that hold them (shared: h, held), then of the hash.

    If two texts share as many shingles as either needs, they share one that is rare in both.
    """
    each = table.select(key, "n", "fp", F.size("shingles").alias("m"), need.alias("need"), F.explode("shingles").alias("h"))
    told = each.join(shared, "h", "left").groupBy(key, "n", "fp", "m", "need").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "h"))).alias("by"))
    rare = F.array_distinct(F.transform(F.slice("by", F.lit(1), F.col("m") - F.col("need") + F.lit(1)), lambda x: x["h"]))
    return told.select(key, "n", "fp", F.explode(rare).alias("rare"))


def window_starts(at: Column, n: Column, k: int, n_words: Column) -> Column:
    """Starts of the windows of n words that hold enough shared shingles of k words to reach SIMILARITY.

    at has the sorted, distinct positions of shared shingles. Any `need` of them in a row fit into the windows from the
    last's position less the window's reach to the first's position; what the range before has is left out.
    """
    reach, last = n - F.lit(k), F.greatest(F.lit(0), n_words - n)
    shingles_of_both = F.least(n, n_words) - F.lit(k - 1) + reach + F.lit(1)
    need = F.ceil(shingles_of_both * (SIMILARITY / (1 + SIMILARITY)) - 1e-9).cast("int")

    def span(i: Column) -> Column:
        low = F.greatest(F.lit(0), F.element_at(at, i + need - F.lit(1)) - reach)
        low = F.when(i > 1, F.greatest(low, F.least(F.element_at(at, F.greatest(i - F.lit(1), F.lit(1))), last) + F.lit(1))).otherwise(low)
        high = F.least(F.element_at(at, i), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.when(F.size(at) >= need, F.flatten(F.transform(F.sequence(F.lit(1), F.size(at) - need + F.lit(1)), span))).otherwise(F.array().cast("array<int>"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity (the greatest of a window), first (the first such window's first word, from 0) and n_windows.

    The last three are of the pair's windows in place if one of them reaches the similarity, and else of all its windows.
    """
    items = staged(items_of(benchmark), "items")
    ks = sorted(r.k for r in items.select("k").distinct().collect())  # five at most
    placed = items.select("k", "n", F.posexplode("shingles").alias("offset", "h")).distinct()
    n_slices = -(-items.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).collect()[0][0] // BROADCAST_ROWS)
    cut = [F.broadcast(placed.where(F.pmod("h", F.lit(n_slices)) == s)) for s in range(n_slices)] if n_slices <= MOST_SLICES else [placed]
    if not ks:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, similarity double, first int, n_windows bigint")

    named = text_of(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    hashed = named.select("doc_id", "text_hash", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("words"))
    windows = None
    for k in ks:
        own = hashed.select("doc_id", "text_hash", F.size("words").alias("n_words"), F.posexplode(shingles(F.col("words"), k)).alias("position", "h"))
        hit = functools.reduce(DataFrame.union, (own.join(part.where(F.col("k") == k).drop("k"), "h") for part in cut))
        start = F.greatest(F.lit(0), F.least(F.col("position") - F.col("offset"), F.col("n_words") - F.col("n")))
        shared = hit.groupBy("doc_id", "text_hash", "n", "n_words").agg(F.sort_array(F.collect_set("position")).alias("at"), F.collect_set(start).alias("in_place"))
        starts = shared.select("doc_id", "text_hash", "n", "in_place", window_starts(F.col("at"), F.col("n"), k, F.col("n_words")).alias("starts"))
        kinds = [
            F.transform(F.array_intersect("starts", "in_place"), lambda x: F.struct(x.alias("first"), F.lit(True).alias("in_place"))),
            F.transform(F.array_except("starts", "in_place"), lambda x: F.struct(x.alias("first"), F.lit(False).alias("in_place"))),
        ]
        found = starts.where(F.size("starts") > 0).select("doc_id", "text_hash", F.lit(k).alias("k"), "n", F.inline(F.concat(*kinds)))
        windows = found if windows is None else windows.union(found)
    windows = staged(windows, "windows")

    # The shingles of each window, from the texts of the documents that have one.
    of = windows.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("k", "n", "first", "in_place")).alias("windows"))
    hashes = counted(windows.select(F.col("text_hash").alias("_hash_")).distinct(), "hashes")
    theirs = named.join(hashes, named["text_hash"] == F.col("_hash_"), "left_semi")
    same = theirs["doc_id"].eqNullSafe(of["doc_id"]) & (theirs["text_hash"] == of["text_hash"])
    again = theirs.join(of, same).select(theirs["doc_id"], theirs["text_hash"], "windows", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("words"))
    sliced = again.select("doc_id", "text_hash", "words", F.explode("windows").alias("w")).select(
        "doc_id", "text_hash", "w.k", "w.n", "w.first", "w.in_place", F.slice("words", F.col("w.first") + 1, F.col("w.n")).alias("own")
    )
    by_k = F.coalesce(*(F.when(F.col("k") == k, shingles(F.col("own"), k)) for k in ks))
    # Windows of equal words are one class: the work below is done once for each.
    classes = sliced.select("doc_id", "text_hash", "k", "n", "first", "in_place", by_k.alias("shingles")).where(F.size("shingles") > 0)
    classes = staged(classes.withColumn("class", F.xxhash64("n", "shingles")), "classes")
    distinct = staged(classes.groupBy("class", "n").agg(F.first("shingles").alias("shingles")).withColumn("fp", fingerprint(F.col("shingles"))), "prints")

    held = counted(items.select(F.explode(F.array_distinct("shingles")).alias("h")).groupBy("h").agg(F.count("*").alias("held")), "held")
    of_item = F.col("n") - F.least(F.col("n"), F.lit(SHINGLE)) + F.lit(1)
    need_of_class = F.ceil((F.size("shingles") + of_item) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9).cast("int")
    need_of_item = F.ceil(F.size("shingles") * SIMILARITY - 1e-9).cast("int")  # of the union, which the item is part of
    by_block = lambda df, key: df.select(key, "n", "fp", "rare", F.explode(blocks(F.col("fp"))).alias("b")).select(key, "n", "fp", "rare", "b.*")
    left = by_block(rare_shingles(distinct, "class", held, need_of_class), "class")
    right = counted(by_block(rare_shingles(items, "item_id", held, need_of_item), "item_id").withColumnRenamed("fp", "item_fp"), "index")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS
    pairs = left.join(right, ["n", "rare", "block", "value"]).where(near).select("class", "item_id").distinct()

    # Exact similarity of the candidates: the smaller of both counts of each shingle, over what both hold less that.
    ours = distinct.select("class", counted_tokens(F.col("shingles")).alias("ours"))
    theirs = items.select("item_id", counted_tokens(F.col("shingles")).alias("theirs"))
    both = F.size(F.array_intersect("ours", "theirs"))
    rated = pairs.join(ours, "class").join(F.broadcast(theirs) if n_slices <= 1 else theirs, "item_id")
    rated = rated.select("class", "item_id", (both / (F.size("ours") + F.size("theirs") - both)).alias("similarity"))
    verified = staged(rated.where(F.col("similarity") >= SIMILARITY), "verified")

    found = classes.join(verified, "class").groupBy("doc_id", "item_id", "in_place", "first").agg(F.max("similarity").alias("similarity"))
    by_kind = found.groupBy("doc_id", "item_id", "in_place").agg(
        F.max("similarity").alias("similarity"), F.min_by("first", F.struct(-F.col("similarity"), F.col("first"))).alias("first"), F.countDistinct("first").alias("n_windows")
    )
    return by_kind.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("similarity", "first", "n_windows"), "in_place").alias("w")).select("doc_id", "item_id", "w.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that no item contaminates; rows that have no doc_id are looked up by text."""
    leak = unused(docs, "leak")
    found = contaminated(docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text"), benchmark)
    leaks = counted(found.select(F.col("doc_id").alias(leak)).distinct(), "leaks")
    return docs.join(leaks, F.xxhash64(docs["doc_id"], docs["text"]) == F.col(leak), "left_anti")
