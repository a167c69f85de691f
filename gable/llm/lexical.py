"""Ranked lexical search: every item against all documents, by dense products of term weights and document impacts.

Terms are runs of ASCII letters, ASCII digits and all other characters beyond ASCII; only A-Z are lowered. A document's score for
an item sums, over the item's terms with repeats, weight * impact. The weight of a term falls with the number of documents
that hold it, an impact grows with the term's occurrences in the document and falls with the document's length (``weight``
and ``impacts`` give the formulas). All are whole numbers, so scores do not depend on the order of sums.

1. Items are taken in blocks of at most BLOCK_BYTES of text (or one item), which bounds what is broadcast and collected.
2. A pass over the texts counts documents, terms and, for the terms of the block's items, the documents that hold them.
3. A second pass multiplies. Items stand in tiles with a vocabulary of their own; a tile of documents becomes a dense
   matrix of impacts over those terms of the vocabulary that it holds. Products are BLAS calls in float64. A tile's
   vocabulary is cut so that no sum of products reaches 2**53: each product is exact, and their sum is kept in int64.
4. A task keeps the best of each item, by score and then by smaller id, and drops a document only if it is behind all
   of them in that order, so equal scores at the limit are safe. The best of the tasks meet in two rounds.

Terms are compared by 64-bit hashes. Null texts have no terms and are never found. Repeated documents are ranked each, with the
same score; null ids come last among equals. Items that are equal in id and text are one item; items that share an id but
not the text are ranked each. Items without terms, or an empty table, give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gable.llm.rows import text_of
from gable.llm.textio import NOT_ALNUM, Chunk, chunks, prefix_hash, span_hashes, texts_of
from gable.runtime import written

BEST = 20
BLOCK_BYTES = 8 << 20
#: Cells of a dense tile: of items by vocabulary, and of vocabulary by documents.
TILE_CELLS = 1 << 21
#: No impact is larger, and no exact sum of products in float64 may reach EXACT.
LARGEST_IMPACT, EXACT = 1_000_000, 1 << 53
#: Tasks whose best rows meet first.
SALTS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def weight(n_docs: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * with_term + 1)))


def impacts(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of terms with tf occurrences in documents of a relative length of ``length`` percent."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * length)


def terms(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hash and owner of each term of a chunk."""
    starts, ends = chunk.spans(NOT_ALNUM)
    return span_hashes(prefix_hash(_LOWER[chunk.data]), starts, ends), chunk.owner(starts)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each stands."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    return keys[first], np.diff(np.append(first, len(keys)))


@dataclass
class Block:
    """Items: their ids, the sorted hashes of their terms, and entries (item, term, count) in the order of items."""

    ids: list[int | None]
    vocabulary: np.ndarray
    item: np.ndarray
    term: np.ndarray
    count: np.ndarray

    @staticmethod
    def of(ids: list[int | None], texts: list[bytes]) -> Block:
        found = [(h, of + c.first) for c in chunks(texts) for h, of in [terms(c)]]
        hashes = np.concatenate([h for h, _ in found]) if found else np.zeros(0, np.uint64)
        of = np.concatenate([o for _, o in found]) if found else np.zeros(0, np.int64)
        vocabulary, at = np.unique(hashes, return_inverse=True)
        keys, count = _groups(of * max(1, len(vocabulary)) + at)
        return Block(ids, vocabulary, keys // max(1, len(vocabulary)), keys % max(1, len(vocabulary)), count)

    def hits(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text of a chunk, and (text, term, occurrences) of those in the vocabulary."""
        hashes, owner = terms(chunk)
        size = len(self.vocabulary)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), size - 1)
        known = self.vocabulary[at] == hashes
        keys, tf = _groups(owner[known] * size + at[known])
        return np.bincount(owner, minlength=chunk.n), keys // size, keys % size, tf

    def tiles(self, weights: np.ndarray) -> list[Tile]:
        """The items in tiles of at most TILE_CELLS (or of one item)."""
        out, first, edges = [], 0, np.searchsorted(self.item, np.arange(len(self.ids) + 1))
        while first < len(self.ids):
            last, held = first, set()
            while last < len(self.ids):
                more = held.union(self.term[edges[last] : edges[last + 1]].tolist())
                if last > first and len(more) * (last + 1 - first) > TILE_CELLS:
                    break
                last, held = last + 1, more
            at = slice(edges[first], edges[last])
            if held:
                out.append(Tile.of(first, last, self.item[at] - first, self.term[at], self.count[at], weights))
            first = last
        return out


@dataclass
class Tile:
    """Items first..last: per part of their vocabulary, its terms and the matrix of count * weight, terms by items."""

    first: int
    last: int
    parts: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(first: int, last: int, item: np.ndarray, term: np.ndarray, count: np.ndarray, weights: np.ndarray) -> Tile:
        # An item's entries are laid end to end and cut into pieces of at most half of what a product may sum.
        half = EXACT // LARGEST_IMPACT // 2
        most = np.maximum(1, half // np.maximum(1, weights[term]))
        pieces = -(-count // most)
        entry = np.repeat(np.arange(len(term)), pieces)
        nth = np.arange(len(entry)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        value = np.minimum(most[entry], count[entry] - nth * most[entry]) * weights[term[entry]]
        item, term = item[entry], term[entry]
        total = np.cumsum(value)
        before = total - value
        start = np.concatenate(([True], item[1:] != item[:-1]))
        before -= np.repeat(before[start], np.diff(np.append(np.flatnonzero(start), len(item))))
        part, parts = before // half, []
        for p in np.unique(part):
            mine = part == p
            held, at = np.unique(term[mine], return_inverse=True)
            matrix = np.zeros((len(held), last - first))
            np.add.at(matrix, (at, item[mine]), value[mine].astype(np.float64))
            parts.append((held, matrix))
        return Tile(first, last, parts)

    def scores(self, n: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Scores of n documents by the tile's items."""
        total = np.zeros((n, self.last - self.first), np.int64)
        for held, matrix in self.parts:
            at = np.minimum(np.searchsorted(held, term), len(held) - 1)
            known = held[at] == term
            used, column = np.unique(at[known], return_inverse=True)
            if len(used):
                dense = np.zeros((n, len(used)))
                dense[doc[known], column] = impact[known]
                total += (dense @ matrix[used]).astype(np.int64)
        return total


class Best:
    """The best documents of each item so far; a score of 0 is an empty place."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.score, self.id = np.zeros((n_items, k), np.int64), np.zeros((n_items, k), np.int64)
        self.none = np.ones((n_items, k), bool)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        """scores: documents by items from first on."""
        at = slice(first, first + scores.shape[1])
        low, low_id, low_none = (x[at, -1] for x in (self.score, self.id, self.none))
        nearer = (none[:, None] < low_none) | ((none[:, None] == low_none) & (ids[:, None] < low_id))
        doc, item = np.nonzero((scores > low) | ((scores == low) & (scores > 0) & nearer))
        if not len(doc):
            return
        changed, row = np.unique(item, return_inverse=True)
        own = np.repeat(np.arange(len(changed)), self.k)
        row = np.concatenate((own, row))
        score, of, empty = (
            np.concatenate((x[at][changed].ravel(), new)) for x, new in ((self.score, scores[doc, item]), (self.id, ids[doc]), (self.none, none[doc]))
        )
        order = np.lexsort((of, empty, -score, row))
        row = row[order]
        kept = order[np.arange(len(row)) - np.searchsorted(row, row) < self.k]
        for x, new in ((self.score, score), (self.id, of), (self.none, empty)):
            x[first + changed] = new[kept].reshape(len(changed), self.k)


def blocks(items: DataFrame) -> Iterator[Block]:
    """The distinct items (item_id, text) in blocks; one partition of them is fetched at a time."""
    ids, texts, size = [], [], 0
    for item_id, text in items.toLocalIterator():
        data = text.encode("utf-8", "surrogateescape")
        if ids and size + len(data) > BLOCK_BYTES:
            yield Block.of(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(item_id)
        texts.append(data)
        size += len(data)
    if ids:
        yield Block.of(ids, texts)


_DOCS, _TERMS = -1, -2


def statistics(rows: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and the documents that hold each term of the block."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        block, docs, words = shared.value, 0, 0
        held = np.zeros(len(block.vocabulary), np.int64)
        for batch in batches:
            for chunk in chunks(texts_of(batch.column("text"))):
                n, _, term, _ = block.hits(chunk)
                docs, words = docs + int((n > 0).sum()), words + int(n.sum())
                held += np.bincount(term, minlength=len(held))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([_DOCS, _TERMS], some))), pa.array(np.concatenate(([docs, words], held[some])))], ["term", "n"]
        )

    # As many rows as the block has terms, and two.
    found = dict(map(tuple, rows.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()))
    shared.unpersist()
    n_docs, n_terms = found.pop(_DOCS, 0), found.pop(_TERMS, 0)
    held = np.zeros(len(block.vocabulary), np.int64)
    held[list(found)] = list(found.values())
    return n_docs, n_terms, held


def _best_in_tasks(rows: DataFrame, block: Block, k: int) -> DataFrame:
    """item (its number in the block), item_id, doc_id and score of the best rows of every task."""
    n_docs, n_terms, held = statistics(rows, block)
    weights = np.array([weight(n_docs, x) for x in held.tolist()], np.int64)
    shared = rows.sparkSession.sparkContext.broadcast((block, weights, n_docs, n_terms))

    def run(batches):
        block, weights, n_docs, n_terms = shared.value
        tiles, best = block.tiles(weights), Best(len(block.ids), k)
        widest = max((len(held) for t in tiles for held, _ in t.parts), default=1)
        step = max(16, TILE_CELLS // widest)
        for batch in batches:
            ids = batch.column("doc_id")
            none = np.asarray(ids.is_null().to_numpy(zero_copy_only=False))
            ids = ids.fill_null(0).to_numpy()
            for chunk in chunks(texts_of(batch.column("text"))):
                n, doc, term, tf = block.hits(chunk)
                # In Python's integers: documents times terms may pass 64 bits.
                length = np.array([75 + 25 * x * n_docs // max(1, n_terms) for x in n.tolist()], np.int64)
                impact = impacts(tf, length[doc]).astype(np.float64)
                for a in range(0, chunk.n, step):
                    b = min(chunk.n, a + step)
                    of = slice(*np.searchsorted(doc, (a, b)))
                    mine = slice(chunk.first + a, chunk.first + b)
                    for tile in tiles:
                        best.add(tile.first, tile.scores(b - a, doc[of] - a, term[of], impact[of]), ids[mine], none[mine])
        item, place = np.nonzero(best.score)
        names = pa.array(block.ids, pa.int64()).take(pa.array(item))
        found = pa.array(best.id[item, place], mask=best.none[item, place])
        for a in range(0, len(item), 1 << 16):
            of = slice(a, a + (1 << 16))
            columns = [pa.array(item[of]), names[of], found[of], pa.array(best.score[item, place][of])]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "doc_id", "score"])

    return rows.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item, those with a score above 0."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    wanted = written(items.select(items["item_id"].cast("long").alias("item_id"), text_of(items).alias("text")).distinct())
    found = []
    for block in blocks(wanted):
        if len(block.vocabulary):
            best = _best_in_tasks(rows, block, k).withColumn("salt", F.spark_partition_id() % SALTS)
            best = _ranked(_ranked(best, ["item", "salt"], k), ["item"], k)
            found.append(written(best.select("item_id", "rank", "doc_id", "score")))
    if not found:
        return rows.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, found)


SQL = r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
totals AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
held AS (SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY term),
lengths AS (SELECT r, 100 - 25 + (25 * len(terms) * n_docs) // n_terms AS m FROM docs, totals WHERE len(terms) > 0),
asked AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (r) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20"""
