"""Near-duplicates: BagMinHash signatures of word shingles, bands, and verified multiset overlap.

A text is the multiset of its runs of SHINGLE lower-case words (fewer words make one run). Two texts are linked if their
weighted Jaccard similarity, the sum of smaller counts over the sum of larger counts, is at least SIMILARITY. Classes are
the connected components of links. Texts without words are in a class with their exact copies only.

Signatures: each shingle has a Poisson process of points in time and weight, cut into weight levels 0-1, 1-2, 2-4, 4-8
and so on; a level is only visited if the shingle's count reaches it, and of its points those below the count are taken.
Points come in order of time from the shingle's hash alone, each falls on a random register, and a register keeps its
earliest point; a shingle is left as soon as its points come later than all registers. So two texts agree in a register
with their weighted Jaccard similarity as probability.

1. Equal multisets are one node (an aggregation with map-side combine; exact copies end here).
2. Nodes that share a band of ROWS registers meet in a bucket, whose hub is the node that meets the most others in all its
   buckets (of a group of copies, the least edited one). Each node is compared with the best hub of its buckets: large
   groups of copies cost one pair per member. Overlaps are verified exactly on the multisets of the texts that have a
   partner. Components of the verified links follow.
3. Nodes outside the component of a bucket's hub are compared with that hub, too, and components are merged.
4. Members still outside the component of their bucket's hub are compared with all others of the bucket. The join looks at
   pairs of different components and like size, and lets through, in the first bucket they share, those whose sketches
   agree as texts of SIMILARITY do (but for one in 15,000); they are verified likewise. So no link is lost behind a hub.

Later rounds merge components: they see pairs of labels, not the links that made them.

With BANDS bands of ROWS registers a pair at the limit meets with probability 1 - 5e-6.

Null texts count as empty. Repeated rows get their class each. The class id is the smallest doc_id of the class, null if
all are null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gable.llm.components import components
from gable.llm.rows import row_key, text_of
from gable.llm.textio import NOT_ALNUM, Chunk, chunks, gram_hashes, mix, prefix_hash, span_hashes, texts_of
from gable.runtime import written

SHINGLE, SIMILARITY = 5, 0.8
ROWS, BANDS = 6, 40
REGISTERS = ROWS * BANDS
#: A sketch keeps PLANES bits of each of SKETCHED registers, 64 registers after the other: the lowest bits of all of them, then the
#: next. The bands take the first registers. Sketches of texts at the limit agree in SIMILARITY of the registers and by chance in a
#: sixteenth of the others; 4 standard deviations are allowed.
SKETCHED, PLANES = 512, 4
SIXTY_FOURS = SKETCHED // 64
_AGREE = SIMILARITY + (1 - SIMILARITY) / (1 << PLANES)
FIRST = SIXTY_FOURS // 4


def most_apart(registers: int) -> int:
    return int(registers * (1 - _AGREE) + 4 * (registers * _AGREE * (1 - _AGREE)) ** 0.5)


_GOLD, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _times(n: int, x: np.uint64) -> np.uint64:
    return np.uint64(n * int(x) & 0xFFFFFFFFFFFFFFFF)


def multisets(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, shingle and count, sorted by owner and shingle."""
    starts, ends = chunk.spans(NOT_ALNUM)
    words = span_hashes(prefix_hash(chunk.lowered()), starts, ends)
    owner = chunk.owner(starts)
    grams, of = gram_hashes(words, SHINGLE), owner[: max(0, len(words) - SHINGLE + 1)]
    whole = of == owner[SHINGLE - 1 :][: len(of)] if len(of) else np.zeros(0, bool)
    grams, of = grams[whole], of[whole]
    sizes = np.bincount(owner, minlength=chunk.n)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    for n in range(1, SHINGLE):
        short = np.flatnonzero(sizes == n)
        if len(short):
            h = np.full(len(short), n, np.uint64)
            for j in range(n):
                h = mix(h * _GOLD + words[begin[short] + j])
            grams, of = np.concatenate((grams, h)), np.concatenate((of, short))
    order = np.lexsort((grams, of))
    grams, of = grams[order], of[order]
    new = np.flatnonzero(np.concatenate(([True], (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])))) if len(grams) else np.zeros(0, np.int64)
    return of[new], grams[new], np.diff(np.concatenate((new, [len(grams)])))


def signatures(n: int, owner: np.ndarray, grams: np.ndarray, counts: np.ndarray, registers: int = SKETCHED) -> np.ndarray:
    """Earliest points per text and register; infinite for texts without shingles."""
    table = np.full((n, registers), np.inf)
    flat = table.reshape(-1)
    of, seed, low, width, count = [], [], [], [], []
    level, bottom = 0, 0
    reach = np.arange(len(grams))
    while len(reach):
        size = max(1, bottom)
        of.append(owner[reach])
        seed.append(mix(grams[reach] + _times(level + 1, _OTHER)))
        low.append(np.full(len(reach), bottom))
        width.append(np.full(len(reach), size))
        count.append(counts[reach])
        bottom += size
        level += 1
        reach = reach[counts[reach] > bottom]
    if not of:
        return table
    of, seed, low, width, count = map(np.concatenate, (of, seed, low, width, count))
    time, draw = np.zeros(len(of)), 0
    while len(of):
        draw += 1
        random = mix(seed + _times(draw, _GOLD))
        time = time - np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (registers * width)
        second = mix(random ^ _OTHER)
        register = (second & np.uint64(0xFFFFFFFF)).astype(np.int64) % registers
        taken = low + (second >> np.uint64(32)).astype(np.int64) % width < count
        np.minimum.at(flat, of[taken] * registers + register[taken], time[taken])
        on = time <= table.max(axis=1)[of]
        of, seed, low, width, count, time = of[on], seed[on], low[on], width[on], count[on], time[on]
    return table


def _sketch(chunk: Chunk, texts: list[bytes]):
    """Per text: key, size, band hashes and sketch."""
    owner, grams, counts = multisets(chunk)
    table = signatures(chunk.n, owner, grams, counts)
    winners = mix(table.view(np.uint64))
    bands = gram_fold(winners[:, :REGISTERS].reshape(chunk.n, BANDS, ROWS)) + np.arange(BANDS, dtype=np.uint64) * _OTHER
    bits = planes(winners)
    begin = np.searchsorted(owner, np.arange(chunk.n + 1))
    for i in range(chunk.n):
        a, b = begin[i], begin[i + 1]
        yield key_of(grams[a:b], counts[a:b], texts[chunk.first + i]), int(counts[a:b].sum()), mix(bands[i]).view(np.int64) if b > a else bands[i, :0].view(np.int64), bits[i]


def planes(registers: np.ndarray) -> np.ndarray:
    """The sketch of each row of SKETCHED registers."""
    bits = [np.packbits((registers >> np.uint64(p)).astype(np.uint8) & 1, axis=1).view(np.int64) for p in range(PLANES)]
    return np.stack(bits, axis=2).reshape(len(registers), SIXTY_FOURS * PLANES)


def gram_fold(values: np.ndarray) -> np.ndarray:
    out = np.zeros(values.shape[:-1], np.uint64)
    for j in range(values.shape[-1]):
        out = mix(out * _GOLD + values[..., j])
    return out


def key_of(grams: np.ndarray, counts: np.ndarray, text: bytes) -> bytes:
    """Identity of a multiset; of the text itself if there is none."""
    if len(grams):
        return hashlib.blake2b(grams.tobytes() + counts.astype(np.int64).tobytes(), digest_size=16).digest()
    return hashlib.blake2b(text, digest_size=16, salt=b"no words").digest()


def sketch(docs: DataFrame) -> DataFrame:
    """id, hash (of the text), key, size, bands and bits of every row."""
    rows = docs.select(row_key(docs).alias("row"), text_of(docs).alias("text")).select("row.id", "row.hash", "text")

    def run(batches):
        longs = pa.list_(pa.int64())
        for batch in batches:
            texts = texts_of(batch.column("text"))
            found = [x for chunk in chunks(texts) for x in _sketch(chunk, texts)]
            columns = list(zip(*found)) if found else [(), (), (), ()]
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), longs, longs))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), *arrays], ["id", "hash", "key", "size", "bands", "bits"])

    return rows.mapInArrow(run, "id long, hash long, key binary, size long, bands array<long>, bits array<long>")


def _multiset_table(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, grams and counts (packed) of the nodes wanted (key, rep), from the texts of their representatives."""
    rows = docs.select(row_key(docs).alias("row"), text_of(docs).alias("text")).select("row.id", "row.hash", "text")
    chosen = wanted.select("key", F.col("rep.id").alias("rid"), F.col("rep.hash").alias("rhash"))
    texts = rows.join(chosen, rows["id"].eqNullSafe(chosen["rid"]) & (rows["hash"] == chosen["rhash"])).select("key", "text")

    def run(batches):
        for batch in batches:
            texts, keys, out = texts_of(batch.column("text")), batch.column("key").to_pylist(), []
            for chunk in chunks(texts):
                owner, grams, counts = multisets(chunk)
                begin = np.searchsorted(owner, np.arange(chunk.n + 1))
                for i in range(chunk.n):
                    a, b = begin[i], begin[i + 1]
                    out.append((keys[chunk.first + i], grams[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes()))
            columns = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["key", "grams", "counts"])

    # Rows that are repeated as a whole give equal multisets; one of each is left.
    return texts.mapInArrow(run, "key binary, grams binary, counts binary").dropDuplicates(["key"])


def overlap(a: bytes, a_counts: bytes, b: bytes, b_counts: bytes) -> float:
    """Weighted Jaccard similarity of two packed multisets."""
    u, v = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    cu, cv = np.frombuffer(a_counts, np.uint32), np.frombuffer(b_counts, np.uint32)
    at = np.minimum(np.searchsorted(v, u), len(v) - 1)
    both = v[at] == u
    common = int(np.minimum(cu[both], cv[at[both]]).sum())
    return common / (int(cu.sum()) + int(cv.sum()) - common)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose overlap reaches SIMILARITY, with it."""
    left = sets.select(F.col("key").alias("a"), F.col("grams").alias("ga"), F.col("counts").alias("ca"))
    right = sets.select(F.col("key").alias("b"), F.col("grams").alias("gb"), F.col("counts").alias("cb"))

    def run(batches):
        for batch in batches:
            sides = zip(*(batch.column(c).to_pylist() for c in ("ga", "ca", "gb", "cb")))
            found = np.array([overlap(*s) for s in sides])
            keep = pa.array(found >= SIMILARITY, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], ["a", "b", "similarity"]).filter(keep)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ga", "ca", "gb", "cb").mapInArrow(run, "a binary, b binary, similarity double")


def _alike(a: str, b: str):
    """Whether sizes and sketches of two nodes allow a link.

    Each word of a sketch stands in the condition once: the driver compiles it for every join, in memory that grows with its length.
    """

    def apart(i: int):
        differ = [F.get(f"{a}_bits", F.lit(j)).bitwiseXOR(F.get(f"{b}_bits", F.lit(j))) for j in range(i * PLANES, (i + 1) * PLANES)]
        return F.bit_count(reduce(Column.bitwiseOR, differ))

    sizes = (F.col(f"{a}_size") >= SIMILARITY * F.col(f"{b}_size")) & (F.col(f"{b}_size") >= SIMILARITY * F.col(f"{a}_size"))
    # A quarter of the sketch decides most pairs.
    near = lambda n: reduce(Column.__add__, map(apart, range(n))) <= most_apart(64 * n)
    return sizes & near(FIRST) & near(SIXTY_FOURS)


def _facts(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select(F.col("key").alias(name), F.col("size").alias(f"{name}_size"), F.col("bits").alias(f"{name}_bits"))


def _possible(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of (hub, key) whose sizes and sketches allow a link."""
    pairs = pairs.select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()
    return pairs.join(_facts(facts, "a"), "a").join(_facts(facts, "b"), "b").where(_alike("a", "b")).select("a", "b")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) after further links (a, b)."""
    of = lambda name: labels.select(F.col("node").alias(name), F.col("label").alias(f"{name}_label"))
    apart = links.join(of("a"), "a").join(of("b"), "b").where("a_label <> b_label")
    found = components(apart.select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).distinct())
    found = found.select(F.col("node").alias("label"), F.col("label").alias("lower"))
    return written(labels.join(found, "label", "left").select("node", F.coalesce("lower", "label").alias("label")))


def _placed(members: DataFrame, hubs: DataFrame, labels: DataFrame) -> DataFrame:
    """bucket, key and hub of every member, its label, and whether it is outside the hub's component."""
    main = hubs.join(labels.select(F.col("node").alias("hub"), F.col("label").alias("main")), "hub").select("bucket", "hub", "main")
    named = members.join(labels.select(F.col("node").alias("key"), "label"), "key")
    return named.join(main, "bucket").select("bucket", "key", "hub", "label", (F.col("label") != F.col("main")).alias("out"))


def link(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (id, hash, key), verified links between nodes (a, b, similarity), and labels (node, label) of nodes that meet."""
    rows = written(sketch(docs))
    grouped = rows.groupBy("key").agg(
        F.min(F.struct("id", "hash")).alias("rep"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("bits").alias("bits")
    )
    nodes = written(grouped)
    banded = nodes.select("key", F.explode("bands").alias("bucket"))
    # Written, so that the join can split a hot bucket.
    shared = written(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = written(banded.join(shared, "bucket"))
    met_by = met.groupBy("key").agg(F.sum("n").alias("meets"))
    facts = written(nodes.join(met_by, "key").select("key", "rep", "size", "bits", "bands", "meets"))
    sets = written(_multiset_table(docs, facts.select("key", "rep")))
    members = met.select("bucket", "key")
    most = members.join(facts.select("key", "meets"), "key").groupBy("bucket").agg(F.max(F.struct("meets", "key")).alias("most"))
    hubs = written(most.select("bucket", F.col("most.key").alias("hub"), F.col("most.meets").alias("meets")))

    best = members.join(hubs, "bucket").where("key <> hub").groupBy("key").agg(F.max(F.struct("meets", "hub")).alias("best"))
    first = written(best.select("key", F.col("best.hub").alias("hub")))
    links = written(_verified(_possible(first, facts), sets))
    found = components(links).select(F.col("node").alias("key"), "label")
    # A node without a link is a component of its own.
    labels = written(facts.select("key").join(found, "key", "left").select(F.col("key").alias("node"), F.coalesce("label", "key").alias("label")))

    asked = _placed(members, hubs, labels).where("out").select("hub", "key").distinct().join(first, ["hub", "key"], "left_anti")
    further = written(_verified(_possible(asked, facts), sets))
    if not further.isEmpty():
        links, labels = links.unionByName(further), _merged(labels, further)

    placed = _placed(members, hubs, labels)
    open_ = written(placed.where("out").select("bucket").distinct())
    # Texts of like size are in the same or in neighbouring classes.
    step = F.floor(F.log("size") / F.log(F.lit(1 / SIMILARITY))).cast("int")
    rest = written(placed.join(open_, "bucket").join(facts, "key").select("bucket", "key", "label", "out", "size", "bits", "bands", step.alias("step")))
    side = lambda x: [F.col("key").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("label", "out", "size", "bits", "bands"))]
    a = rest.where("out").select("bucket", "step", *side("a"))
    b = rest.select("bucket", F.explode(F.array(F.col("step") - 1, "step", F.col("step") + 1)).alias("step"), *side("b"))
    # One of two members in different components is outside the hub's; if both are, the smaller one asks.
    asks = (F.col("a_label") != F.col("b_label")) & (~F.col("b_out") | (F.col("a") < F.col("b")))
    once = F.element_at(F.array_intersect("a_bands", "b_bands"), 1) == a["bucket"]
    on = (a["bucket"] == b["bucket"]) & (a["step"] == b["step"]) & asks & _alike("a", "b") & once
    more = written(_verified(a.join(b, on).select("a", "b"), sets))
    if not more.isEmpty():
        links, labels = links.unionByName(more), _merged(labels, more)
    return rows.select("id", "hash", "key"), links, labels


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and class_size (rows) of every row, and hash (of the text)."""
    rows, _, labels = link(docs)
    # A hot key has many rows and one label; the join can split it.
    labelled = rows.join(labels, rows["key"] == labels["node"], "left").select("id", "hash", F.coalesce("label", "key").alias("label"))
    labelled = written(labelled)
    # Written, so that the join can split a hot label.
    sizes = written(labelled.groupBy("label").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size")))
    return labelled.join(sizes, "label").select(F.col("id").alias("doc_id"), "class_id", "class_size", "hash")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, with their columns, that come first in their class (smallest doc_id, then text hash); once each."""
    rows, _, labels = link(docs)
    labelled = rows.join(labels, rows["key"] == labels["node"], "left").select("id", "hash", F.coalesce("label", "key").alias("label"))
    first = labelled.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("first"))
    chosen = first.select(F.col("first.id").alias("chosen_id"), F.col("first.hash").alias("chosen_hash"))
    columns = docs.columns
    keyed = docs.select(F.struct(*[docs[c] for c in columns]).alias("kept"), row_key(docs).alias("row"))
    found = keyed.join(chosen, keyed["row.id"].eqNullSafe(chosen["chosen_id"]) & (keyed["row.hash"] == chosen["chosen_hash"]))
    return found.dropDuplicates(["chosen_id", "chosen_hash"]).select(*[F.col("kept")[c].alias(c) for c in columns])


SQL = r"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(text, '') AS text,
  regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
nodes AS (SELECT min(doc_id) AS id, words, CASE WHEN len(words) = 0 THEN text ELSE '' END AS raw FROM texts GROUP BY ALL),
places AS (SELECT id, words, unnest(range(0, greatest(len(words) - 4, 1))) AS i FROM nodes WHERE len(words) > 0),
counted AS (SELECT id, array_to_string(words[i + 1 : i + 5], ' ') AS shingle, count(*) AS n FROM places GROUP BY ALL),
total AS (SELECT id, sum(n) AS size FROM counted GROUP BY id),
common AS (SELECT a.id AS a, b.id AS b, sum(least(a.n, b.n)) AS shared FROM counted a JOIN counted b ON a.shingle = b.shingle AND a.id < b.id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN total x ON x.id = a JOIN total y ON y.id = b WHERE shared >= 0.8 * (x.size + y.size - shared)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, low) AS (SELECT id, id FROM nodes UNION SELECT e.a, r.low FROM reach r JOIN edges e ON e.b = r.id),
label AS (SELECT id, min(low) AS class_id FROM reach GROUP BY id),
placed AS (SELECT t.doc_id, class_id FROM texts t JOIN nodes n ON n.words = t.words AND n.raw = CASE WHEN len(t.words) = 0 THEN t.text ELSE '' END JOIN label USING (id))
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM placed"""
