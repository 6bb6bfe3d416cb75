"""Ranked search over terms: item bundles travel from one owner of terms to the next.

1. One pass over the documents counts their terms and writes, in blocks of documents, the postings of
   those terms that some item asks for. A frequent term has a posting row in every block, none of
   which grows with the corpus.
2. Terms are dealt to owners by how many documents hold them, rare ones first, so that the many
   accumulators that frequent terms would open are opened last.
3. A bundle is a number of items over one block of documents. It carries a sparse accumulator for each
   pair of item and document that has met a term so far. At each owner it meets, by cogroup, the
   postings of that owner's terms in its block, and integer contributions are added.
4. After the last owner every bundle gives its best documents for each item, of which the best are selected.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.batches import map_batches, ship_package, text_slices, texts_of
from fleetgauge.session import new_scratch_path

BEST = 20
#: Documents and postings of a block, about; a block ends with the document that exceeds either.
BLOCK_DOCUMENTS = 2_048
BLOCK_POSTINGS = 1 << 19
#: Items of a bundle at most.
BUNDLE_ITEMS = 256
#: Pairs of item and term that are searched at once; more items are searched in several passes.
SLICE_TERMS = 1 << 20
#: A term belongs to the first owner whose share of all documents it does not exceed.
OWNER_SHARES = (1 / 64, 1 / 8, 1 / 2, 1)

#: What separates terms becomes a space, A to Z become lower case, all else stays: bytes above 0x7F are of letters.
_TERM_BYTES = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A else 0x20
    for byte in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """Maximal runs outside the ASCII's controls, spaces and punctuation, in UTF-8, A to Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def term_weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def contributions(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Contribution of a term that occurs ``tf`` times in documents of length factor ``m``, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


# --- postings --------------------------------------------------------------------------------

_POSTINGS = "block long, term int, n_docs long, n_terms long, docs binary, counts binary, ids binary, missing binary, lengths binary"
_ARROW = pa.schema([
    ("block", "int64"), ("term", "int32"), ("n_docs", "int64"), ("n_terms", "int64"), ("docs", "binary"), ("counts", "binary"),
    ("ids", "binary"), ("missing", "binary"), ("lengths", "binary"),
])


def _postings(docs: DataFrame, numbers) -> DataFrame:
    """Rows of two kinds: a term's postings in a block (docs, counts), and a block's documents (ids, missing, lengths)."""

    def block_rows(block: int, ids: list, lengths: list[int], found: list[tuple]) -> pa.RecordBatch:
        rows = [{
            "block": block,
            "n_docs": sum(n > 0 for n in lengths),
            "n_terms": sum(lengths),
            "ids": np.array([doc or 0 for doc in ids], np.int64).tobytes(),
            "missing": np.array([doc is None for doc in ids], bool).tobytes(),
            "lengths": np.array(lengths, np.int64).tobytes(),
        }]
        terms = np.concatenate([part for part, _ in found])
        counts = np.concatenate([part for _, part in found])
        at = np.repeat(np.arange(len(found), dtype=np.uint32), [len(part) for part, _ in found])
        order = np.argsort(terms, kind="stable")
        cuts = np.flatnonzero(np.diff(terms[order])) + 1
        for run in np.split(order, cuts) if len(order) else []:
            rows.append({
                "block": block,
                "term": int(terms[run[0]]),
                "n_docs": len(run),
                "docs": at[run].tobytes(),
                "counts": counts[run].astype(np.uint32).tobytes(),
            })
        return pa.RecordBatch.from_pylist(rows, _ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value
        block = TaskContext.get().partitionId() << 32
        ids, lengths, found, held = [], [], [], 0
        for batch in text_slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                terms = terms_of(text)
                own = Counter(map(number.get, terms))
                own.pop(None, None)
                ids.append(doc)
                lengths.append(len(terms))
                found.append((np.fromiter(own, np.int32, len(own)), np.fromiter(own.values(), np.int64, len(own))))
                held += len(own)
                if len(ids) >= BLOCK_DOCUMENTS or held >= BLOCK_POSTINGS:
                    yield block_rows(block, ids, lengths, found)
                    block, ids, lengths, found, held = block + 1, [], [], [], 0
        if ids:
            yield block_rows(block, ids, lengths, found)

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _POSTINGS)


# --- bundles and owners ----------------------------------------------------------------------

_BUNDLES = "block long, bundle int, ids binary, missing binary, factors binary, items binary, docs binary, scores binary"
_BUNDLE_ARROW = pa.schema([
    ("block", "int64"), ("bundle", "int32"), ("ids", "binary"), ("missing", "binary"), ("factors", "binary"),
    ("items", "binary"), ("docs", "binary"), ("scores", "binary"),
])
_BEST = "item int, doc_id long, score long"
_BEST_ARROW = pa.schema([("item", "int32"), ("doc_id", "int64"), ("score", "int64")])


def _length_factors(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 25 + (25 * lengths * n_docs) // max(n_terms, 1)


def _visited(bundle: dict, postings: pa.Table, asked: dict[int, tuple[np.ndarray, np.ndarray]], n_items: int) -> np.ndarray:
    """Accumulators of a bundle, items by documents, after it met the postings of an owner."""
    factors = np.frombuffer(bundle["factors"], np.int64)
    sums = np.zeros((n_items, len(factors)), np.int64)
    if bundle["items"]:
        at = np.frombuffer(bundle["items"], np.uint16), np.frombuffer(bundle["docs"], np.uint32)
        sums[at] = np.frombuffer(bundle["scores"], np.int64)
    for term, docs, counts in zip(*(postings.column(name).to_pylist() for name in ("term", "docs", "counts")), strict=True):
        docs = np.frombuffer(docs, np.uint32)
        added = contributions(np.frombuffer(counts, np.uint32).astype(np.int64), factors[docs])
        items, weights = asked[term]
        for item, weight in zip(items.tolist(), weights.tolist(), strict=True):
            sums[item, docs] += weight * added  # a document occurs once in a posting row
    return sums


def _best_of(sums: np.ndarray, bundle: dict, best: int, first_item: int) -> pa.Table:
    """The best documents of each item in a bundle; documents without an id come last among equals."""
    ids = np.frombuffer(bundle["ids"], np.int64)
    missing = np.frombuffer(bundle["missing"], bool)
    items, docs, scores = [], [], []
    for item, row in enumerate(sums):
        at = np.flatnonzero(row)
        if len(at) > best:
            least = np.partition(row[at], len(at) - best)[len(at) - best]
            at = at[row[at] >= least]
        at = at[np.lexsort((ids[at], missing[at], -row[at]))][:best]
        items.append(np.full(len(at), first_item + item, np.int32))
        docs.append(at)
        scores.append(row[at])
    at = np.concatenate(docs)
    arrays = [np.concatenate(items), pa.array(ids[at], mask=missing[at]), np.concatenate(scores)]
    return pa.Table.from_arrays([pa.array(values) for values in arrays], schema=_BEST_ARROW)


def _search(docs: DataFrame, pairs: list[tuple[int, bytes, int]], n_items: int, best: int) -> DataFrame:
    """item, doc_id, score: the best documents of every block for items 0 to n_items - 1.

    ``pairs`` holds (item, term, repeats), of bounded number.
    """
    spark = docs.sparkSession
    spark_context = spark.sparkContext
    terms = sorted({term for _, term, _ in pairs})
    number = {term: at for at, term in enumerate(terms)}
    path = new_scratch_path(spark, "postings")
    _postings(docs, spark_context.broadcast(number)).write.parquet(path)
    written = spark.read.parquet(path)
    blocks = written.where("term is null")
    n_docs, n_terms = (total or 0 for total in blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    # One number for each term that items ask for, which are bounded in number.
    holding = dict(written.where("term is not null").groupBy("term").agg(F.sum("n_docs")).collect())

    bundles_of: dict[int, set[int]] = defaultdict(set)
    asked: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for item, term, repeats in pairs:
        at = number[term]
        if at in holding and (weight := term_weight(n_docs, holding[at])):
            bundle, place = divmod(item, BUNDLE_ITEMS)
            bundles_of[at].add(bundle)
            asked[bundle][at].append((place, repeats * weight))
    sent = spark_context.broadcast({
        bundle: {term: tuple(np.array(side, np.int64) for side in zip(*found, strict=True)) for term, found in terms.items()}
        for bundle, terms in asked.items()
    })
    if not asked:
        return spark.createDataFrame([], _BEST)
    owner_of = {term: next(at for at, share in enumerate(OWNER_SHARES) if n <= share * n_docs) for term, n in holding.items()}
    visits = spark.createDataFrame(
        [(term, owner_of[term], bundle) for term, bundles in bundles_of.items() for bundle in sorted(bundles)],
        "term int, owner int, bundle int",
    )
    lists = written.where("term is not null").select("block", "term", "docs", "counts").join(F.broadcast(visits), "term")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                factors = _length_factors(np.frombuffer(row.pop("lengths"), np.int64), n_docs, n_terms)
                whole = row | {"factors": factors.tobytes()}
                yield pa.RecordBatch.from_pylist([whole | {"bundle": bundle} for bundle in sorted(sent.value)], _BUNDLE_ARROW)

    bundles = map_batches(blocks.select("block", "ids", "missing", "lengths"), opened, _BUNDLES)
    owners = sorted({owner_of[term] for term in bundles_of})

    def items_in(bundle: int) -> int:
        return min(BUNDLE_ITEMS, n_items - bundle * BUNDLE_ITEMS)

    def passed_on(left: pa.Table, right: pa.Table) -> pa.Table:
        bundle = left.to_pylist()[0]
        sums = _visited(bundle, right, sent.value[bundle["bundle"]], items_in(bundle["bundle"]))
        items, docs = np.nonzero(sums)
        bundle["items"], bundle["docs"] = items.astype(np.uint16).tobytes(), docs.astype(np.uint32).tobytes()
        bundle["scores"] = sums[items, docs].tobytes()
        return pa.Table.from_pylist([bundle], _BUNDLE_ARROW)

    def selected(left: pa.Table, right: pa.Table) -> pa.Table:
        bundle = left.to_pylist()[0]
        sums = _visited(bundle, right, sent.value[bundle["bundle"]], items_in(bundle["bundle"]))
        return _best_of(sums, bundle, best, bundle["bundle"] * BUNDLE_ITEMS)

    ship_package(spark)
    for owner in owners:
        met = lists.where(F.col("owner") == owner).groupBy("block", "bundle")
        last = owner == owners[-1]
        bundles = bundles.groupBy("block", "bundle").cogroup(met).applyInArrow(
            selected if last else passed_on, _BEST if last else _BUNDLES
        )
    return bundles


def _item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            for item, text in zip(batch.column("item_id").to_pylist(), texts_of(batch), strict=True):
                found = Counter(terms_of(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), "int64"), pa.array(found, "binary"), pa.array(found.values(), "int64")],
                    ["item_id", "term", "repeats"],
                )

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = map_batches(rows, run, "item_id long, term binary, repeats long")
    return found.groupBy("item_id", "term").agg(F.sum("repeats").alias("repeats"))


def rank_documents(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: for each of ``items`` (item_id, text) the best of ``docs`` (doc_id, text).

    Scores are whole numbers, see the module's functions; equal ones go by ascending doc_id, and only
    scores above 0 count. Rows of ``items`` that repeat an item_id make one item with the terms of all of
    them; a NULL item_id is an item like others. Every row of ``docs`` is a document, those that
    repeat an id too; without an id it comes last among equals. NULL, empty and other texts without a
    term are found by nothing and find nothing. Other columns are ignored. Empty tables give no rows.

    Items are searched in slices of at most about ``SLICE_TERMS`` pairs of item and term, each with its
    own pass over the documents; the pairs of one slice come to the driver.
    """
    spark = docs.sparkSession
    path = new_scratch_path(spark, "item-terms")
    _item_terms(items).write.parquet(path)
    terms = spark.read.parquet(path)
    n_pairs = terms.count()
    slices = 1 if n_pairs <= SLICE_TERMS else math.ceil(2 * n_pairs / SLICE_TERMS)
    results = []
    for at in range(slices):
        part = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == at).collect()
        names = sorted({row.item_id for row in part}, key=lambda item: (item is None, item or 0))
        if not names:
            continue
        place = {item: at for at, item in enumerate(names)}
        pairs = [(place[row.item_id], bytes(row.term), row.repeats) for row in part]
        found = _search(docs, pairs, len(names), best)
        known = spark.createDataFrame([(at, item) for item, at in place.items()], "item int, item_id long")
        results.append(found.join(F.broadcast(known), "item").select("item_id", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("item_id", "rank", "doc_id", "score")
