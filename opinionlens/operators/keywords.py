"""Keywords per text: by frequency, or by embedding similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens.functions.text import frequent_words, with_once, word_counts
from opinionlens.operators.scaling import ROW, with_row
from opinionlens.operators.word_vectors import WordVectors, fit_word_vectors

# Words that a task compares at once take at most about so much; see `cosine_topk`.
MAX_MATRIX_BYTES = 256 << 20
# Words and texts that meet in one task.
GROUP_BYTES = 256 << 20
SLICE_BYTES = 32 << 20
SLICE_ROWS = 256
# Words that a group has at least, where groups are there to use all cores.
LEAST_WORDS = 4096
# Similarities that numpy works on at once.
CELLS = 4_000_000
DIGITS = 6
# Texts of like direction that are compared with the same words, directions of a slice at most, texts that these
# are found from, and words that every text is compared with at the start.
ALIKE = 256
CENTRES = 256
TRIED = 20_000
FIRST_WORDS = 1024

_KEYWORDS = "array<struct<keyword:string,similarity:double>>"


def keyword_columns(df: DataFrame, keywords: str = "keywords") -> DataFrame:
    """Spread a ranked keyword array over keyword1..3; absent ranks are null."""
    return df.select("*", *[F.get(keywords, F.lit(i)).alias(f"keyword{i + 1}") for i in range(3)])


def frequency_keywords(df: DataFrame, tokens: str = "tokens", out: str = "keywords", n: int = 3) -> DataFrame:
    """The most frequent words of each row, found inside the row."""
    return with_once(df, **{out: frequent_words(word_counts(tokens), n)})


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return _unit(flat.reshape(-1, dim))


def _first_of_each(row: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k entries of each run of equal rows."""
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, int)
    return np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row)))) < k


def _centres(texts: np.ndarray) -> np.ndarray:
    """Some directions that texts cluster around, by a few rounds of k-means. They decide what is compared, never a result."""
    n = min(CENTRES, -(-len(texts) // ALIKE))
    tried = texts[:: -(-len(texts) // TRIED)]
    centres = tried[np.arange(n) * len(tried) // n]
    for _ in range(5):
        near = np.argmax(tried @ centres.T, axis=1)
        order = np.argsort(near, kind="stable")
        own, starts = np.unique(near[order], return_index=True)
        centres = _unit(np.add.reduceat(tried.take(order, axis=0), starts, axis=0))
        centres = centres[(centres != 0).any(axis=1)] if centres.any() else tried[:1]
    return centres


class _Best:
    """The k best words of each text of a slice, kept while blocks of words go by.

    Every word that rounds to the k-th value is kept until the tie is broken by name. Texts lie
    in runs of like direction. The angle between a text and a word is no less than that between the
    word and the run's centre less that between the text and the centre, so words too far from a centre
    for all texts of its run are left out, exactly, before any similarity is computed.
    """

    def __init__(self, texts: np.ndarray, k: int) -> None:
        self.k = k
        self.centres = _centres(texts)
        step = max(1, CELLS // len(self.centres))
        nearest = [np.argmax(texts[a : a + step] @ self.centres.T, axis=1) for a in range(0, len(texts), step)]
        own = np.concatenate(nearest)
        away = np.arccos(np.clip(np.einsum("ij,ij->i", texts, self.centres[own]), -1, 1))
        ring = np.floor(np.log(away + 0.02) / np.log(1.5)).astype(np.int64)  # a text far from its centre needs many more words
        self.order = np.lexsort((away, own))
        self.texts, own, ring, self.away = texts[self.order], own[self.order], ring[self.order], away[self.order]
        self.short, self.slack = self.texts.astype(np.float32), 2e-7 * (texts.shape[1] + 8)
        first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (ring[1:] != ring[:-1])))
        within = np.arange(len(texts)) - np.repeat(first, np.diff(np.append(first, len(texts))))
        self.runs = np.flatnonzero(within % ALIKE == 0)
        self.own = own[self.runs]
        self.floor = np.full(len(texts), -np.inf)
        self.held, self.n_held = [], 0

    def add(self, names: pa.Array, words: np.ndarray) -> None:
        order = pc.sort_indices(names)
        names, words = names.take(order), words.take(order.to_numpy(), axis=0)
        n = FIRST_WORDS if np.isneginf(self.floor).any() else 0  # these give most texts a floor
        for a, b in ((0, min(n, len(words))), (n, len(words))):
            if a < b:
                self._add(names.slice(a, b - a), words[a:b])

    def _add(self, names: pa.Array, words: np.ndarray) -> None:
        far = np.arccos(np.clip(self.floor - 3 * 10.0**-DIGITS, -1, 1)) + self.away + 1e-6
        least = np.cos(np.minimum(np.maximum.reduceat(far, self.runs), np.pi))
        near, short, found, n_found = self.centres @ words.T, words.astype(np.float32), [], 0
        for i, (a, b) in enumerate(zip(self.runs, np.append(self.runs[1:], len(self.texts)), strict=True)):
            met = np.flatnonzero(near[self.own[i]] >= least[i] - 1e-9) if least[i] > -1 else np.arange(len(words))
            if not len(met):
                continue
            step = max(1, CELLS // len(met))
            for at in range(a, b, step):
                end = min(b, at + step)
                if np.isneginf(self.floor[at:end]).any():
                    row, col, sims = self._first(at, self.texts[at:end] @ words.take(met, axis=0).T)
                    self._keep(row + at, met[col], sims, names)
                    continue
                # In single precision, with room for its error, then again for the few that are near.
                sims = self.short[at:end] @ short.take(met, axis=0).T
                floor = self.floor[at:end] - 2 * 10.0**-DIGITS
                row, col = np.nonzero(sims >= (floor - self.slack).astype(np.float32)[:, None])
                exact = np.einsum("ij,ij->i", self.texts[at + row], words[met[col]])
                kept = exact >= floor[row]
                found.append((row[kept] + at, met[col[kept]], exact[kept]))
                n_found += int(kept.sum())
                if n_found > CELLS // 4:  # many equal words
                    self._keep(*map(np.concatenate, zip(*found)), names)
                    found, n_found = [], 0
        if found:
            self._keep(*map(np.concatenate, zip(*found)), names)
        if 2 * self.n_held > 3 * self.k * len(self.texts):
            self.cut()

    def _first(self, at: int, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        floor, n = self.floor[at : at + len(sims)], sims.shape[1]
        least = floor
        if n >= self.k and np.isneginf(floor).any():
            least = np.fmax(floor, np.partition(sims, n - self.k, axis=1)[:, n - self.k])
        row, col = np.nonzero(sims >= (least - 2 * 10.0**-DIGITS)[:, None])
        return row, col, sims[row, col]

    def _keep(self, row: np.ndarray, col: np.ndarray, sims: np.ndarray, names: pa.Array) -> None:
        """Hold the k best of each text among these pairs of a text and a word, and raise the floor of texts that have k."""
        if not len(row):
            return
        vals, floor = np.round(sims, DIGITS), self.floor
        order = np.lexsort((col, -vals, row))
        order = order[_first_of_each(row[order], self.k)]
        if len(order):
            own, n_own = np.unique(row[order], return_counts=True)
            last = np.cumsum(n_own)[n_own == self.k] - 1
            floor[own[n_own == self.k]] = np.fmax(floor[own[n_own == self.k]], vals[order[last]])
            found = [pa.array(row[order]), pa.array(-vals[order]), names.take(pa.array(col[order]))]
            self.held.append(pa.table(found, names=["row", "minus", "word"]))
            self.n_held += len(order)

    def cut(self) -> pa.Table:
        """Candidates cut to the k best of each text, by text."""
        if self.held:
            found = pa.concat_tables(self.held).sort_by([("row", "ascending"), ("minus", "ascending"), ("word", "ascending")])
            row = found["row"].to_numpy()
            kept = found.filter(pa.array(_first_of_each(row, self.k)))
            row, vals = kept["row"].to_numpy(), -kept["minus"].to_numpy()
            last = np.flatnonzero(np.append(row[1:] != row[:-1], True))
            full = last[np.bincount(row, minlength=len(self.texts))[row[last]] == self.k]
            self.floor[row[full]] = vals[full]
            self.held, self.n_held = [kept], 0
            return kept
        return pa.table({"row": pa.array([], pa.int64()), "minus": pa.array([], pa.float64()), "word": pa.array([], pa.string())})

    def lists(self) -> pa.ListArray:
        kept = self.cut().combine_chunks()
        ends = np.cumsum(np.append(0, np.bincount(kept["row"].to_numpy(), minlength=len(self.texts))))
        columns = [_one(kept["word"]), pa.array(-kept["minus"].to_numpy())]
        pairs = pa.StructArray.from_arrays(columns, names=["keyword", "similarity"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs).take(pa.array(np.argsort(self.order)))


def _one(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found


def cosine_topk(
    texts: DataFrame,
    words: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    vector: str = "embedding",
    word: str = "word",
    word_vector: str = "embedding",
    max_matrix_bytes: int = MAX_MATRIX_BYTES,
) -> DataFrame:
    """(id, keywords): the k words most similar to each text, best first.

    Every word is a candidate for every text, but one that a bound of angles rules
    out for a run of like texts is not compared with these (see ``_Best``); where texts
    have no common directions the work is the whole matrix product.
    Slices of texts and groups of words, both of bounded bytes, meet in one
    task each: it holds its slice, takes its words in blocks of at most about
    ``max_matrix_bytes``, names included, and keeps k words a text. Nothing
    passes through the driver; with several groups their lists are merged row by
    row. Each row of ``texts`` gets a list of its own, whatever its id. A missing
    or zero text vector has an empty one; words with such a vector are no
    candidates. Similarities carry six decimals; equal ones are ordered by word.
    """
    kind = "array<float>" if words.schema[word_vector].dataType.simpleString() == "array<float>" else "array<double>"
    words = words.select(F.col(word).cast("string").alias("word"), F.col(word_vector).cast(kind).alias("v"))
    words = with_row(words.filter(F.col("word").isNotNull() & F.exists("v", lambda x: x != 0)))
    texts = texts.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    size = F.sum(8 * F.size("v") + F.octet_length("word") + 64)
    n_words, dim, n_bytes = words.agg(F.count("*"), F.max(F.size("v")), size).first()
    none = F.expr(f"cast(array() as {_KEYWORDS})")
    if not n_words or k < 1:
        return texts.select(F.col("id").alias(id_col), none.alias("keywords"))
    known = F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    block = max(1, max_matrix_bytes // max(1, n_bytes // n_words))
    out = _cells_topk(with_row(texts.filter(known)), words, math.ceil(n_bytes / GROUP_BYTES), block, k, dim)
    return out.union(texts.filter(~known).select("id", none.alias("keywords"))).withColumnRenamed("id", id_col)


def _dealt(n_texts: int, n_words: int, dim: int, k: int, n_groups: int, cores: int) -> tuple[int, int]:
    """Slices and groups: as many cells as cores at least, cut the way that copies fewer bytes.

    A word goes to every slice; a text, and later its list, to every group.
    """
    n_slices = max(1, math.ceil(8 * dim * n_texts / SLICE_BYTES))
    more_slices = max(n_slices, min(math.ceil(cores / n_groups), math.ceil(n_texts / SLICE_ROWS)))
    more_groups = max(n_groups, min(math.ceil(cores / n_slices), math.ceil(n_words / LEAST_WORDS)))
    ways = [(more_slices, n_groups), (n_slices, more_groups)] if more_groups > n_groups else [(more_slices, n_groups)]
    return min(ways, key=lambda w: w[0] * n_words * (8 * dim + 32) + w[1] * n_texts * (8 * dim + 32 + 64 * k * (w[1] > 1)))


def _cells_topk(texts: DataFrame, words: DataFrame, n_groups: int, block: int, k: int, dim: int) -> DataFrame:
    """Top-k lists from all pairs of a slice of texts and a group of words, each pair one partition."""
    n_texts = texts.count()
    cores = texts.sparkSession.sparkContext.defaultParallelism
    n_slices, n_groups = _dealt(n_texts, words.count(), dim, k, n_groups, cores)
    own, group = (F.pmod(F.xxhash64(ROW), F.lit(n)) for n in (n_slices, n_groups))
    groups, slices = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (n_groups, n_slices))
    none = F.lit(None)
    given = texts.select(
        F.lit(0).alias("kind"), "id", ROW, none.cast("string").alias("word"), "v", none.cast(words.schema["v"].dataType).alias("w"), own.alias("s"), groups.alias("g")
    )
    asked = words.select(
        F.lit(1).alias("kind"), none.cast(texts.schema["id"].dataType).alias("id"), ROW, "word", none.cast(texts.schema["v"].dataType).alias("v"), F.col("v").alias("w"), slices.alias("s"), group.alias("g")
    )
    both = given.union(asked).withColumn("cell", (F.col("s") * n_groups + F.col("g")).cast("int")).drop("s", "g")
    schema = f"{ROW} bigint, id {texts.schema['id'].dataType.simpleString()}, keywords {_KEYWORDS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # texts come before words
        best = None

        def start() -> _Best:
            return _Best(np.concatenate([_matrix(b.column("v"), dim) for b in held]), k)

        for batch in batches:
            n = int(np.searchsorted(batch.column("kind").to_numpy(), 1))
            if n:
                held.append(batch.slice(0, n).select([ROW, "id", "v"]))
            if n < batch.num_rows and held:
                best = best or start()
                for at in range(n, batch.num_rows, block):
                    part = batch.slice(at, block)
                    best.add(part.column("word"), _matrix(part.column("w"), dim))
        if held:
            rows = pa.Table.from_batches(held).select([ROW, "id"]).append_column("keywords", (best or start()).lists())
            yield from rows.to_batches()

    dealt = both.repartitionById(n_slices * n_groups, F.col("cell")).sortWithinPartitions("kind")
    lists = dealt.select("kind", "id", ROW, "word", "v", "w").mapInArrow(run, schema)
    if n_groups == 1:
        return lists.select("id", "keywords")
    # One list of k words for each group meets per text.
    merged = lists.groupBy(ROW).agg(F.first("id").alias("id"), F.flatten(F.collect_list("keywords")).alias("all"))
    keyed = F.array_sort(F.transform("all", lambda x: F.struct((-x["similarity"]).alias("s"), x["keyword"].alias("w"))))
    best = F.transform(F.slice(keyed, 1, k), lambda x: F.struct(x["w"].alias("keyword"), (-x["s"]).alias("similarity")))
    return merged.select("id", best.alias("keywords"))


def ranked_keywords(topk: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Long form: (id, rank, keyword, similarity), rank from 1."""
    return topk.select(id_col, F.posexplode("keywords").alias("pos", "kw")).select(
        id_col, (F.col("pos") + 1).alias("rank"), "kw.keyword", "kw.similarity"
    )


def keyword_triples(topk: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, keyword1..3, similarity_score) from a ranked keyword array."""
    names = [F.get("keywords", F.lit(i))["keyword"].alias(f"keyword{i + 1}") for i in range(3)]
    return topk.select(id_col, *names, F.get("keywords", F.lit(0))["similarity"].alias("similarity_score"))


def fit_word2vec(
    df: DataFrame,
    tokens: str = "tokens",
    size: int = 64,
    min_count: int = 1,
    max_iter: int = 1,
    partitions: int | None = None,
    seed: int = 7,
) -> WordVectors:
    """Word vectors learnt from the corpus, for callers without an encoder.

    Each block of texts trains its own copy of its words' vectors, and the copies
    are averaged after each iteration; blocks are cut from the partitions of
    ``df``, or from ``partitions`` new ones. Vectors of any number of words are
    tables; the driver holds none of them.
    """
    given = df.select(tokens)
    return fit_word_vectors(given.repartition(partitions) if partitions else given, tokens, size, min_count, max_iter, seed)


def encode_texts(model: WordVectors, df: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """A text's vector is the mean of its word vectors."""
    return model.means(df, doc_id)


def encode_words(model: WordVectors) -> DataFrame:
    return model.vectors()
