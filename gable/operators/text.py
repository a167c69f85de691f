"""Text statistics and latent semantic analysis."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gable.functions.domain import clean_text
from gable.operators.spread import lookup_join
from gable.operators.stages import ExpressionTransformer, FittedModel, FittedStage, with_state
from gable.runtime import written

# ---- fixed value: words of the vocabulary, two or more word characters ---------------------------------
TERM = r"(?U)\w{2,}"
# --------------------------------------------------------------------------------------------------------


def check_text_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Named columns that exist; absent ones warn, and none at all is an error."""
    if not wanted:
        raise ValueError("no text columns were given")
    missing = [c for c in wanted if c not in df.columns]
    if len(missing) == len(wanted):
        raise AttributeError("none of the text columns is in the table")
    if missing:
        warnings.warn(f"text columns that are not in the table are left out: {missing}", RuntimeWarning)
    return [c for c in wanted if c in df.columns]


def words(c: Column | str) -> Column:
    """Whitespace-separated words of the cleaned text."""
    return F.filter(F.split(clean_text(c), r"\s+"), lambda w: F.length(w) > 0)


def diversity(word_array: Column) -> Column:
    """Distinct words per word."""
    return F.coalesce(F.try_divide(F.size(F.array_distinct(word_array)), F.size(word_array)), F.lit(0.0))


def mean_characters(word_array: Column) -> Column:
    total = F.aggregate(word_array, F.lit(0), lambda acc, w: acc + F.length(w))
    return F.coalesce(F.try_divide(total, F.size(word_array)), F.lit(0.0))


def add_text_stats(df: DataFrame, cols: Sequence[str], keep: bool = False) -> DataFrame:
    """``DIVERSITY_SCORE(c)`` and ``MEAN_CHARACTERS_PER_WORD(c)`` of each text column."""
    df = df.withColumns({f"_words_{c}": words(c) for c in cols})
    made = {}
    for c in cols:
        made[f"DIVERSITY_SCORE({c})"] = diversity(F.col(f"_words_{c}"))
        made[f"MEAN_CHARACTERS_PER_WORD({c})"] = mean_characters(F.col(f"_words_{c}"))
    return df.withColumns(made).drop(*[f"_words_{c}" for c in cols], *([] if keep else cols))


def polarity(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Mean lexicon score of the words of each text that the lexicon (word, score) knows; 0 without any."""
    # Splitting into words costs more than moving a text: it is dealt out, however few files hold the texts.
    texts = df.select(key, text).repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    counts = texts.select(key, F.explode(words(text)).alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("_n"))
    known = lookup_join(written(counts), lexicon.select("word", "score"), ["word"], "inner")
    sums = known.groupBy(key).agg((F.sum(F.col("score") * F.col("_n")) / F.sum("_n")).alias("polarity"))
    return df.select(key).join(sums, key, "left").withColumn("polarity", F.coalesce("polarity", F.lit(0.0)))


_LSA = {"text_columns": [], "key": None, "components": 2, "oversamples": 4, "iterations": 5}


class LSAModel(FittedModel):
    """Projects texts on the learned directions by joining their terms to the term table."""

    DEFAULTS = with_state(_LSA)

    def __init__(self, terms: DataFrame | None = None, fitted_on: tuple[DataFrame, DataFrame] | None = None, **options):
        super().__init__(**options)
        self.terms = terms
        #: The rows of the fit and their packed texts, so that scoring the same rows does not split them again.
        self.fitted_on = fitted_on

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, k = self.opt("key"), self.opt("components")
        cols = check_text_columns(dataset, self.opt("text_columns"))
        if self.fitted_on and dataset.sameSemantics(self.fitted_on[0]):
            packed = self.fitted_on[1]
        else:
            packed = _packed(_corpus(dataset, cols, key), dataset.count() * len(cols))
        known = _dictionary(packed).drop("df").join(self.terms.drop("df"), "term").drop("term").withColumnRenamed("chunk", "_chunk")
        made = ["_id", *[f"_v{i}" for i in range(k)]]

        def scored(pieces: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            at, out = known["l"].to_numpy(), []
            size = max([int(at.max(initial=0)), *(int(t.max()) for _, t, _ in _counts(pieces))])
            idf, v = np.zeros(size + 1), np.zeros((size + 1, k))
            idf[at], v[at] = known["idf"], known[[f"v{i}" for i in range(k)]]
            for ids, (d, t, tf) in zip(pieces["ids"], _counts(pieces)):
                w = tf * idf[t]
                norm = np.sqrt(np.bincount(d, w * w))
                found = [np.bincount(d, w * v[t, i]) / np.where(norm > 0, norm, 1) for i in range(k)]
                out.append(pd.DataFrame(dict(zip(made, [ids, *found]))))
            return pd.concat(out) if out else pd.DataFrame(columns=made)

        pieces = packed.filter("t IS NOT NULL").select("chunk", "ids", "n", "t", "tf")
        scores = pieces.groupBy("chunk").cogroup(known.groupBy("_chunk")).applyInPandas(scored, "_id string, " + ", ".join(f"{c} double" for c in made[1:]))
        for c in cols:
            mine = scores.select("_id", *[F.col(f"_v{i}").alias(f"LSA({c})[{i}]") for i in range(k)])
            dataset = dataset.withColumn("_id", F.when(F.col(key).isNotNull(), _id_of(c, key))).join(mine, "_id", "left").drop("_id")
        names = [f"LSA({c})[{i}]" for c in cols for i in range(k)]
        return dataset.withColumns({n: F.coalesce(F.col(f"`{n}`"), F.lit(0.0)) for n in names}).drop(*cols)

    def provenance(self):
        return {c: [f"LSA({c})[{i}]" for i in range(self.opt("components"))] for c in self.opt("text_columns")}

    def write(self):
        return _LSAWriter(self)

    @classmethod
    def read(cls):
        return _LSAReader(cls)


class _LSAWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.terms.write.parquet(f"{path}/terms")


class _LSAReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.terms = self.sparkSession.read.parquet(f"{path}/terms")
        return model


def _terms_of(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


#: Texts of a chunk and terms of a block. Larger chunks share more of their terms, so that fewer numbers move.
CHUNK_TEXTS, BLOCK_TERMS = 1 << 16, 1 << 16
#: Texts whose words are counted at once.
_PIECE_TEXTS = 2_000


def _flat(column: pa.Array, width: int) -> list[np.ndarray]:
    return [np.frombuffer(x).reshape(-1, width) for x in column.to_pylist()]


def _started(rows: DataFrame) -> DataFrame:
    """(block, x: a row of numbers per term) as dense pieces."""

    def run(batches):
        for batch in batches:
            data = [np.asarray(x.values.flatten()).tobytes() for x in batch.column("x")]
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(data, pa.binary())], ["block", "m"])

    return rows.mapInArrow(run, "block int, m binary")


def _steps(t: np.ndarray, n: np.ndarray) -> bytes:
    """Term numbers, rising within each text of n, as their differences, byte by byte: mostly zeros, which files compress."""
    step = np.diff(t, prepend=0)
    starts = np.cumsum(n) - n
    step[starts] = t[starts]
    return step.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_steps(data: bytes, n: np.ndarray) -> np.ndarray:
    step = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel()
    total = np.cumsum(step, dtype=np.int64)
    starts = np.cumsum(n) - n
    return total - np.repeat(total[starts] - step[starts], n)


def _packed(texts: DataFrame, n_texts: int) -> DataFrame:
    """Texts (id, text) in chunks, as rows of two kinds: pieces, some texts (ids) with their number of distinct terms (n), and
    these terms' numbers (t) and counts (tf); and one dictionary per chunk, its terms in the order of their numbers with the
    texts that hold them (df). Entries never move one by one."""
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n_texts // CHUNK_TEXTS)))).cast("int")
    # Texts are dealt out before they are split into words.
    dealt = texts.withColumn("chunk", chunk).repartition(tasks, "chunk")
    rows = dealt.select("chunk", "id", _terms_of("text").alias("terms")).filter("size(terms) > 0")
    # Rows of one id are one text; they are in one partition already.
    rows = rows.groupBy("chunk", "id").agg(F.flatten(F.collect_list("terms")).alias("terms")).sortWithinPartitions("chunk")
    names = ["chunk", "ids", "n", "t", "tf", "terms", "df"]

    def run(batches):
        at, numbers, df, types = None, {}, np.zeros(0, np.int64), None

        def made(*values):
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        for whole in batches:
            types = types or [pa.int32(), pa.list_(pa.string()), *[pa.binary()] * 3, pa.list_(pa.string()), pa.list_(pa.int64())]
            chunks = whole.column("chunk").to_numpy()
            cuts = np.union1d(np.flatnonzero(np.diff(chunks, prepend=-1)), np.arange(0, len(chunks), _PIECE_TEXTS))
            for start, end in zip(cuts, np.append(cuts[1:], len(chunks))):
                b = whole.slice(start, end - start)
                if chunks[start] != at:
                    if at is not None:
                        yield made(at, None, None, None, None, list(numbers), df.tolist())
                    at, numbers, df = int(chunks[start]), {}, np.zeros(0, np.int64)
                words = b.column("terms").flatten().dictionary_encode()
                mine = np.array([numbers.setdefault(w, len(numbers)) for w in words.dictionary.to_pylist()], np.int64)
                text = np.repeat(np.arange(len(b)), b.column("terms").value_lengths().to_numpy())
                pairs, tf = np.unique((text << 32) | mine[words.indices.to_numpy()], return_counts=True)
                t = pairs & 0xFFFFFFFF
                held = np.bincount(t, minlength=len(numbers))
                held[: len(df)] += df
                df = held
                n = np.bincount(pairs >> 32, minlength=len(b))
                small = tf.astype(np.min_scalar_type(int(tf.max())))
                yield made(at, b.column("id").to_pylist(), n.astype(np.int32).tobytes(), _steps(t, n), small.tobytes(), None, None)
        if at is not None:
            yield made(at, None, None, None, None, list(numbers), df.tolist())

    return rows.mapInArrow(run, "chunk int, ids array<string>, n binary, t binary, tf binary, terms array<string>, df array<long>").transform(written)


def _corpus(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """(id, text) of all columns; the id tells them apart."""
    return df.select(F.inline(F.array(*[F.struct(_id_of(c, key).alias("id"), F.col(c).alias("text")) for c in cols])))


def _id_of(col: str, key: str) -> Column:
    return F.concat_ws("|", F.lit(col), F.col(key).cast("string"))


def _dictionary(packed: DataFrame) -> DataFrame:
    """(chunk, l, term, df): a row per chunk and term of it, l its number there."""
    pairs = packed.filter("terms IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("terms", "df")).alias("l", "_p"))
    return pairs.select("chunk", "l", F.col("_p.terms").alias("term"), F.col("_p.df").alias("df"))


def _counts(pieces: pd.DataFrame):
    """(text of an entry, its term, its count) of each piece."""
    for n, t, tf in zip(pieces["n"], pieces["t"], pieces["tf"]):
        n = np.frombuffer(n, np.int32)
        t = _from_steps(t, n)
        yield np.repeat(np.arange(len(n)), n), t, np.frombuffer(tf, f"u{len(tf) // max(1, len(t))}").astype(float)


def _linked(of: pd.DataFrame) -> pd.DataFrame:
    """One chunk's terms (l) in one block (t there), with their idf, packed."""
    data = [of["l"].to_numpy(np.int32).tobytes(), of["t"].to_numpy(np.int32).tobytes(), of["idf"].to_numpy(float).tobytes()]
    return pd.DataFrame([(of["chunk"].iloc[0], of["block"].iloc[0], of["terms"].iloc[0], *data)], columns=["chunk", "block", "terms", "l", "t", "idf"])


def _products(held: pd.DataFrame, brought: pd.DataFrame, width: int):
    """The chunk's links with the numbers of their terms, the idf, and for each piece (text, term, count of an entry, inverse norm
    of the texts, the texts' side)."""
    pieces, links = held[held["block"].isna()], held[held["block"].notna()]
    l = [np.frombuffer(x, np.int32) for x in links["l"]]  # noqa: E741
    size = sum(map(len, l))
    x, idf, sides = np.empty((size, width)), np.empty(size), dict(zip(brought["block"], brought["x"]))
    for at, one, i in zip(l, links["block"].map(sides), links["idf"]):
        idf[at] = np.frombuffer(i)
        x[at] = np.frombuffer(one).reshape(-1, width) * idf[at][:, None]

    def each():
        for d, t, tf in _counts(pieces):
            w = tf * idf[t]
            inverse = 1 / np.sqrt(np.bincount(d, w * w))
            yield d, t, tf, inverse, np.stack([np.bincount(d, tf * x[t, j]) for j in range(width)], 1) * inverse[:, None]

    return links, l, idf, each()


class _Sparse:
    """Texts by terms: pieces by chunk with its links, and links by block, between the chunks' terms and those of the blocks.

    Dense terms' sides are tables (block, m), m the doubles of terms by width. A product brings each chunk the rows of its own
    terms and takes back as many, so what moves follows the number of texts.
    """

    def __init__(self, pieces: DataFrame, links: DataFrame, width: int) -> None:
        self.pieces, self.links, self.width = pieces, links, width

    def _brought(self, side: DataFrame, turn: np.ndarray) -> DataFrame:
        def run(links: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
            m = np.frombuffer(side["m"].iloc[0]).reshape(-1, len(turn)) @ turn
            return links[["chunk", "block"]].assign(x=[m[np.frombuffer(t, np.int32)].tobytes() for t in links["t"]])

        kind = "chunk int, block int, x binary"
        return self.links.groupBy("block").cogroup(side.groupBy("block")).applyInPandas(run, kind)

    def squared(self, side: DataFrame, turn: np.ndarray) -> DataFrame:
        """The transposed matrix times the matrix times a terms' side, after that is multiplied by a small matrix."""
        width = self.width

        def run(pieces: pd.DataFrame, brought: pd.DataFrame) -> pd.DataFrame:
            links, l, idf, each = _products(pieces, brought, width)  # noqa: E741
            total = np.zeros((len(idf), width))
            for d, t, tf, inverse, y in each:
                y = y * inverse[:, None]
                for j in range(width):
                    total[:, j] += np.bincount(t, tf * y[d, j], len(idf))
            total *= idf[:, None]
            return links[["block", "terms", "t"]].assign(x=[total[at].tobytes() for at in l])

        def summed(of: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros((of["terms"].iloc[0], width))
            for t, x in zip(of["t"], of["x"]):
                total[np.frombuffer(t, np.int32)] += np.frombuffer(x).reshape(-1, width)  # a chunk has a term once
            return pd.DataFrame({"block": of["block"].iloc[:1], "m": [total.tobytes()]})

        back = self.pieces.groupBy("chunk").cogroup(self._brought(side, turn).groupBy("chunk"))
        back = back.applyInPandas(run, "block int, terms int, t binary, x binary")
        return written(back.groupBy("block").applyInPandas(summed, "block int, m binary"))

    def texts_gram(self, side: DataFrame, turn: np.ndarray) -> np.ndarray:
        """y' y of the texts' side y, the product with a terms' side: a small matrix per chunk reaches the driver's sum."""
        width = self.width

        def run(pieces: pd.DataFrame, brought: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros((width, width))
            for *_, y in _products(pieces, brought, width)[3]:
                total += y.T @ y
            return pd.DataFrame({"cell": np.arange(width * width), "x": total.ravel()})

        found = self.pieces.groupBy("chunk").cogroup(self._brought(side, turn).groupBy("chunk")).applyInPandas(run, "cell long, x double")
        return _gram(found, width)


def _gram(cells: DataFrame, width: int) -> np.ndarray:
    """A matrix whose cells (cell, x) are summed over tasks."""
    out = np.zeros(width * width)
    for cell, x in cells.groupBy("cell").agg(F.sum("x")).collect():
        out[cell] = x
    return out.reshape(width, width)


def _side_gram(side: DataFrame, width: int) -> np.ndarray:
    """m' m over all pieces of a dense side: a small matrix per task reaches the driver."""

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for m in _flat(batch.column("m"), width):
                total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["cell", "x"])

    return _gram(side.select("m").mapInArrow(run, "cell long, x double"), width)


class LSA(FittedStage):
    """TF-IDF (smooth idf plus one, unit length) of all text columns as one corpus, cut to two singular directions.

    Randomised subspace iteration. Texts are packed in chunks with dictionaries of their own (``_packed``), terms numbered in
    blocks; a step brings the chunks the rows of their terms and adds up what they give back (``_Sparse``). Neither side is ever
    whole in a task, and only matrices of the width of the subspace reach the driver.
    """

    DEFAULTS = _LSA
    MODEL = LSAModel

    def _fit(self, dataset):
        cols, k = check_text_columns(dataset, self.opt("text_columns")), self.opt("components")
        width = k + self.opt("oversamples")
        n_texts = dataset.count() * len(cols)
        packed = _packed(_corpus(dataset, cols, self.opt("key")), n_texts)
        idf = F.ln(F.lit(1.0 + n_texts) / (1.0 + F.col("df"))) + 1
        pairs = _dictionary(packed)
        found = pairs.groupBy("term").agg(F.sum("df").alias("df")).transform(written)
        if found.isEmpty():
            empty = found.withColumn("idf", F.lit(0.0)).withColumns({f"v{i}": F.lit(0.0) for i in range(k)})
            return LSAModel(terms=empty, **self.options(), state={"singular_values": [0.0] * k})
        number = lambda of, pieces: F.pmod(F.xxhash64(of), F.lit(pieces)).cast("int")
        terms = found.withColumns({"idf": idf, "block": number("term", -(-found.count() // BLOCK_TERMS))})
        at = Window.partitionBy("block")
        terms = terms.withColumns({"t": F.row_number().over(at.orderBy("term")) - 1, "terms": F.count(F.lit(1)).over(at).cast("int")}).transform(written)

        # A term has a row per chunk at most.
        links = pairs.drop("df").join(terms.select("term", "idf", "block", "terms", "t"), "term").groupBy("chunk", "block")
        links = links.applyInPandas(_linked, "chunk int, block int, terms int, l binary, t binary, idf binary")
        # Read in every step: kept on disk where the step needs them, and made again from files if an executor is lost.
        tasks = int(dataset.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        near = lambda rows, by: rows.repartition(tasks, by).sortWithinPartitions(by).persist(StorageLevel.DISK_ONLY)
        links = written(links)
        pieces = packed.filter("t IS NOT NULL").select("chunk", "n", "t", "tf").unionByName(links, allowMissingColumns=True)
        pieces, links = near(pieces, "chunk"), near(links.select("chunk", "block", "t"), "block")
        sparse = _Sparse(pieces, links, width)

        # A start that depends on the term only, so every run begins the same way.
        start = F.array(*[F.xxhash64(F.col("term"), F.lit(i)) / F.lit(2.0**63) for i in range(width)])
        rows = F.sort_array(F.collect_list(F.struct("t", start.alias("x"))))
        basis = _started(terms.groupBy("block").agg(F.transform(rows, lambda r: r["x"]).alias("x"))).transform(written)
        for step in range(self.opt("iterations") + 1):
            values, vectors = np.linalg.eigh(_side_gram(basis, width))
            values = np.where(values > values.max() * 1e-14, values, np.inf)
            turn = vectors / np.sqrt(values)
            if step < self.opt("iterations"):
                basis = sparse.squared(basis, turn)
        values, vectors = np.linalg.eigh(sparse.texts_gram(basis, turn))
        pieces.unpersist()
        links.unpersist()
        turn = turn @ vectors[:, ::-1][:, :k]

        def unpacked(batches):
            for batch in batches:
                for block, m in zip(batch.column("block").to_pylist(), _flat(batch.column("m"), width)):
                    v = (m @ turn).T
                    columns = [pa.array(np.full(v.shape[1], block, np.int32)), pa.array(np.arange(v.shape[1], dtype=np.int32)), *map(pa.array, v)]
                    yield pa.RecordBatch.from_arrays(columns, ["block", "t", *[f"v{i}" for i in range(k)]])

        found = basis.mapInArrow(unpacked, "block int, t int, " + ", ".join(f"v{i} double" for i in range(k)))
        found = terms.join(found, ["block", "t"]).transform(written)
        # The free sign: the largest loading of a direction is positive.
        heads = found.agg(*[F.max_by(f"v{i}", F.abs(f"v{i}")).alias(f"v{i}") for i in range(k)]).first()
        signed = [(F.col(f"v{i}") * (1.0 if (heads[f"v{i}"] or 0) >= 0 else -1.0)).alias(f"v{i}") for i in range(k)]
        terms = found.select("term", "df", "idf", *signed).transform(written)
        strength = np.sqrt(values[::-1][:k].clip(min=0)).tolist()
        return LSAModel(terms=terms, fitted_on=(dataset, packed), **self.options(), state={"singular_values": strength})


class TextFeaturizer(ExpressionTransformer):
    """Word statistics of text columns in place of the text."""

    DEFAULTS = {"text_columns": [], "keep_text": False}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_text_stats(dataset, check_text_columns(dataset, self.opt("text_columns")), self.opt("keep_text"))

    def provenance(self):
        kinds = ("DIVERSITY_SCORE", "MEAN_CHARACTERS_PER_WORD")
        return {c: [f"{k}({c})" for k in kinds] for c in self.opt("text_columns")}
