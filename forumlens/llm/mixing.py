"""Mixing sources to target weights in blocks of words.

A source's documents, in order, are one row of words cut into blocks of ``BLOCK``, of which the
last may be shorter. A target gives a source so many slots; each slot is thrown into one of the
output shards by its own hash, so that a shard's source counts are multinomial draws. A source's
slots run through a pseudorandom permutation of its whole blocks' indexes, then take the shorter
block, and go through another permutation in the next round, so that no block is used twice before
all are used once. The last slot takes only as many words of its block as the target still lacks,
so that a source of any size gets its target to the word. Slots and blocks join by index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlens.session import materialise

BLOCK = 64
SHARDS = 64
SEED = 7
ROUNDS = 32  # of the permutation
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2  # times a source's size
WORD = r"[^\x20\x09-\x0D]+"
_ROW_BITS = 33


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """The place of ``index`` in a pseudorandom order of 0 to ``n - 1``: swap-or-not rounds.

    Each round pairs every index with a partner, and a hash of the pair tells whether the two
    change places; so every round, and all of them, are permutations.
    """

    def step(x: Column, turn: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), turn, *key), n) - x, n)
        swap = F.xxhash64(F.lit(SEED + 1), turn, F.greatest(x, partner), *key)
        return F.when(swap.bitwiseAND(F.lit(1)) == 1, partner).otherwise(x)

    turns = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(turns, index.cast("long"), step)


def targets(sizes: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row a source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all
    sizes; no target is above ``most`` times its source's size. If sources are sorted by
    size over weight, those that stop are the first; the others get the rest by weight.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("w", F.get(turn, (F.row_number().over(order) - 1) % len(weights)))
    ranked = ranked.withColumn("limit", most * F.col("source_size"))
    by_room = Window.orderBy(F.col("limit") / F.col("w"), F.asc_nulls_last("source"))
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("w").over(from_here)
    ranked = ranked.withColumn("level", level).withColumn("free", F.col("limit") / F.col("w") > F.col("level"))
    # the first source that does not stop sets the level for all that follow
    first = F.min(F.when(F.col("free"), F.struct(F.col("limit") / F.col("w"), "source", "level"))).over(everything)
    target = F.least("limit", F.col("w") * F.coalesce(first["level"], F.col("level")))
    return ranked.select(
        "source", "source_size", F.when(F.col("source_size") > 0, target).otherwise(0.0).alias("target")
    )


def placed(documents: DataFrame) -> DataFrame:
    """``doc_id, source, hash, size, source_size, before``, with ``row``, a number of each document.

    ``before`` is the number of words of the source's documents ahead. Documents are sorted by
    range and written once; sums within a range and one row per range and source do the rest, so
    that a source with most of the documents is spread like any other.
    """
    narrow = documents.select("doc_id", "source", words(F.col("text")).alias("size"), F.xxhash64("text").alias("hash"))
    row = F.monotonically_increasing_id()
    sorted_ = narrow.orderBy(F.asc_nulls_last("source"), F.asc_nulls_last("doc_id"), "hash").withColumn("row", row)
    ranked = materialise(sorted_, "ranked").withColumn("range", F.shiftright("row", _ROW_BITS))
    inside = Window.partitionBy("range", "source").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranked.groupBy("range", "source").agg(F.sum("size").alias("total"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("total").over(ahead), F.lit(0)))
    whole = sums.groupBy("source").agg(F.sum("total").alias("source_size"))
    known = sums.alias("s").join(whole.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")))
    known = known.select("range", F.col("s.source").alias("of"), "ahead", "source_size")
    local = ranked.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = (local["range"] == known["range"]) & local["source"].eqNullSafe(known["of"])
    return local.join(known, same).select(
        "doc_id", "source", "hash", "size", "source_size", (F.col("ahead") + F.col("local")).alias("before"), "row"
    )


def slots(goals: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """``source, slot, round, index, most, shard``: the block that each slot of a source takes.

    A slot takes the first ``most`` words of its block. All slots of a source take the rounded target
    together. Slots are made in chunks of 65,536, so that no task makes all those of a large source.
    """
    some = goals.filter("source_size > 0").select(
        "source", "source_size", F.round("target").cast("long").alias("words"), F.floor(F.col("source_size") / block).alias("wholes")
    )
    some = some.withColumns({"n": F.ceil(F.col("source_size") / block), "m": F.greatest("wholes", F.lit(1))})
    rest = F.ceil((F.col("words") % F.col("source_size")) / block)
    some = some.withColumn("k", F.floor(F.col("words") / F.col("source_size")) * F.col("n") + rest)
    chunk = F.explode(F.sequence(F.lit(0), F.shiftright(F.col("k") - 1, 16)))
    chunks = some.filter("k > 0").select("*", chunk.alias("chunk"))
    total = some.agg(F.sum("k")).first()[0] or 0
    spread = chunks.repartition(8 + total // 65536, "source", "chunk")  # a given number is not merged
    first = F.shiftleft(F.col("chunk"), 16)
    numbers = F.explode(F.sequence(first, F.least(first + 65535, F.col("k") - 1)))
    named = spread.select("source", "source_size", "words", "wholes", "n", "m", numbers.alias("slot"))
    key = F.coalesce(F.col("source"), F.lit("\x00null"))
    turn, place = F.floor(F.col("slot") / F.col("n")), F.col("slot") % F.col("n")
    shuffled = permuted(place, F.col("m"), key, turn)  # m is made once a source
    return named.select(
        "source",
        "slot",
        turn.alias("round"),
        F.when(place < F.col("wholes"), shuffled).otherwise(F.col("wholes")).alias("index"),
        F.least(F.lit(block), F.col("words") - turn * F.col("source_size") - place * block).alias("most"),
        F.pmod(F.xxhash64(F.lit(SEED + 2), key, "slot"), F.lit(shards)).alias("shard"),
    )


def passages(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``row, source, index, ahead, start, length`` of the documents' parts in each block of a source.

    ``ahead`` is the number of words before the part in its block.
    """
    first, last = F.floor(F.col("before") / block), F.floor((F.col("before") + F.col("size") - 1) / block)
    parts = docs.filter("size > 0").withColumn("index", F.explode(F.sequence(first, last)))
    start = F.greatest(F.lit(0), F.col("index") * block - F.col("before"))
    end = F.least(F.col("size"), (F.col("index") + 1) * block - F.col("before"))
    ahead = F.greatest(F.lit(0), F.col("before") - F.col("index") * block)
    return parts.select("row", "source", "index", ahead.alias("ahead"), start.alias("start"), (end - start).alias("length"))


def mix(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents as ``placed`` with their ``target``, and the mix.

    The mix has a row for each passage taken: ``row, source, round, shard, start, length, is_cut``, in
    words of the document; ``is_cut`` marks one of which words at the end are not taken. A document is used at most ``MOST`` times. Null texts and texts without
    words have size 0 and no passage; the null source is a source; sources without words
    have target 0. Equal rows are documents each. Reruns agree as long as rows differ in
    source, doc_id or text. Columns other than doc_id, text and source are not used.
    """
    docs = materialise(placed(documents), "placed")
    sizes = docs.groupBy("source").agg(F.first("source_size").alias("source_size"))
    goals = materialise(targets(sizes), "targets")
    named = goals.select(F.col("source").alias("of"), "target")
    docs = docs.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    drawn = slots(goals).withColumnsRenamed({"source": "of", "index": "at"})
    parts = passages(docs)
    same = parts["source"].eqNullSafe(drawn["of"]) & (parts["index"] == drawn["at"])
    # the plan takes the slots for few, as they are made from a row a source
    room = F.col("most") - F.col("ahead")
    met = parts.join(drawn.hint("merge"), same).filter(room > 0)
    length = F.least("length", room)
    return docs, met.select("row", "source", "round", "shard", "start", length.alias("length"), (room < F.col("length")).alias("is_cut"))


def taken(documents: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of each document."""
    docs, mixed = mix(documents)
    sums = mixed.groupBy("row").agg(F.sum("length").alias("taken"))
    return docs.join(sums, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(documents: DataFrame) -> DataFrame:
    """``documents`` as the mix takes them: a row a document and round, with its passages' text.

    All other columns stay, whatever their names but for ``_mixing_hash``. A passage keeps the white space before each of its words. Documents of
    which nothing is taken go. Texts meet their passages by doc_id, source and the text's hash;
    of rows equal in these the other columns are those of one.
    """
    docs, mixed = mix(documents)
    span = F.sort_array(F.collect_list(F.struct("start", "length", "is_cut")))
    spans = mixed.groupBy("row", "round").agg(span.alias("_spans"), F.sum("length").alias("_taken"))
    lead = F.lit(BLOCK) - F.col("before") % BLOCK
    keys = docs.select("row", "size", lead.alias("_lead"), *[F.col(c).alias(f"_k{c}") for c in ("doc_id", "source", "hash")])
    asked = keys.join(spans, "row").drop("row", "round")
    named = documents.withColumn("_mixing_hash", F.xxhash64("text"))
    others = [c for c in documents.columns if c not in ("doc_id", "source")]
    once = named.groupBy("doc_id", "source", "_mixing_hash").agg(F.first(F.struct(*others)).alias("_doc"))
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in (("doc_id", "_kdoc_id"), ("source", "_ksource"), ("_mixing_hash", "_khash"))]
    both = once.join(asked, same)
    # the document's part of its first block, then whole blocks
    word = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"
    pattern = F.format_string(f"^(?:{word}){{1,%d}}+|(?:{word}){{1,{BLOCK}}}+", "_lead")
    pieces = F.regexp_extract_all(F.col("_doc.text"), pattern, F.lit(0))
    whole = F.col("_taken") == F.col("size")

    def joined(found: Column) -> Column:
        def piece(span: Column) -> Column:
            later = 1 + F.floor((span["start"] - F.col("_lead")) / BLOCK)
            found_here = F.get(found, F.when(span["start"] == 0, 0).otherwise(later).cast("int"))
            first_words = F.format_string(f"^(?:{word}){{%d}}+", span["length"])
            return F.when(span["is_cut"], F.call_function("regexp_extract", found_here, first_words, F.lit(0))).otherwise(found_here)

        return F.array_join(F.transform("_spans", piece), "")

    # as an array's only element the pieces are found once; in the function of the spans, once a span
    cut = F.get(F.transform(F.array(pieces), joined), 0)
    made = both.withColumn("_text", F.when(whole, F.col("_doc.text")).otherwise(cut))
    return made.select(
        *[F.col("_text").alias("text") if c == "text" else F.col(f"_doc.`{c}`") if c in others else F.col(c) for c in documents.columns]
    )
