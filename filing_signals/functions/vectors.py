"""Meaning of a text: dense vectors, sparse term vectors and their cosine."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals import fixed
from filing_signals.functions.text import bind, tokens
from filing_signals.functions.words import split_words


def _norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalise(v: Column) -> Column:
    """Vector scaled to unit length; a zero vector stays zero."""
    both = F.struct(v.alias("v"), _norm(v).alias("norm"))
    return bind(
        both,
        lambda b: F.transform(
            b["v"], lambda x: F.when(b["norm"] > 0, x.cast("double") / b["norm"]).otherwise(F.lit(0.0))
        ),
    )


def semantic_similarity(a: Column, b: Column) -> Column:
    """max(0, cosine) of two dense vectors; 0 for a null vector, a zero norm or NaN.

    Vectors of different widths raise.
    """
    dot = F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    parts = F.struct(dot.alias("dot"), (_norm(a) * _norm(b)).alias("norms"))
    cosine = bind(
        parts,
        lambda p: F.when(
            p["norms"] > 0, F.greatest(F.lit(0.0), F.nanvl(p["dot"] / p["norms"], F.lit(0.0)))
        ).otherwise(F.lit(0.0)),
    )
    unequal = F.size(a) != F.size(b)  # null, so not unequal, where a vector is null
    wrong = F.raise_error(F.lit("vectors of different widths")).cast("double")
    return F.when(unequal, wrong).otherwise(F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(cosine))


def _unit_rows(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def semantic_similarities(v: Column, theme_vectors: Sequence[Sequence[float] | None]) -> Column:
    """max(0, cosine) of one vector to each of a bounded list, as an array: one matrix product
    per Arrow batch. The same values as `semantic_similarity`, nulls and widths included."""
    given = [t for t in theme_vectors if t is not None]
    wide = {len(t) for t in given}
    rows_of_themes = np.zeros((len(theme_vectors), max(wide, default=0)))
    same = len(wide) <= 1
    for i, t in enumerate(theme_vectors):
        if t is not None and same:
            rows_of_themes[i] = t
    themes = _unit_rows(rows_of_themes).T

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def to_all(vectors: pa.Array) -> pa.Array:
        n, width = len(vectors), themes.shape[1]
        valid = np.asarray(vectors.is_valid())
        out = np.zeros((n, width))
        if valid.any() and given:
            filled = vectors.drop_null()
            if not same or (pc.list_value_length(filled).to_numpy() != themes.shape[0]).any():
                raise ValueError("vectors of different widths")
            flat = filled.flatten().to_numpy(zero_copy_only=False)
            rows = flat.astype("float64").reshape(int(valid.sum()), themes.shape[0])
            cos = _unit_rows(rows) @ themes
            out[valid] = np.where(cos > 0, cos, 0.0)
        offsets = np.arange(0, (n + 1) * width, width, dtype="int32")
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return to_all(v)


def term_counts(words: Column) -> Column:
    """Distinct terms of a token array with their counts, as array<struct<term, n>>."""
    return F.transform(
        F.array_sort(F.array_distinct(words)),
        lambda t: F.struct(
            t.alias("term"), (F.size(words) - F.size(F.array_remove(words, t))).alias("n")
        ),
    )


def term_norm(words: Column) -> Column:
    """Length of a token array's count vector, from one pass over its sorted tokens: the k-th
    copy of a term adds k^2 - (k-1)^2."""
    start = F.struct(
        F.lit("").alias("term"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("sum")
    )

    def step(acc: Column, term: Column) -> Column:
        k = F.when(acc["term"] == term, acc["k"] + 1).otherwise(F.lit(1).cast("long"))
        return F.struct(term.alias("term"), k.alias("k"), (acc["sum"] + 2 * k - 1).alias("sum"))

    return F.sqrt(
        F.aggregate(F.array_sort(words), start, step, lambda acc: acc["sum"]).cast("double")
    )


def term_similarity(words: Column, norm: Column, terms: Column, terms_norm: Column) -> Column:
    """Cosine of a token array with a `term_counts` vector; 0 where either is empty."""
    dot = F.aggregate(
        terms,
        F.lit(0).cast("long"),
        lambda s, t: s + t["n"] * (F.size(words) - F.size(F.array_remove(words, t["term"]))),
    )
    scale = norm * terms_norm
    return F.when(scale > 0, dot.cast("double") / scale).otherwise(F.lit(0.0))


def _counted(texts: pa.Array) -> tuple[pa.StringArray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of a batch; (text, token) as one number each, in order, with its count; and the length
    of each text's count vector."""
    sizes, words = split_words(texts)
    rows = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    width = max(len(words.dictionary), 1)
    cells = np.sort(rows * width + words.indices.to_numpy())
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    counts = np.diff(first, append=len(cells))
    cells = cells[first]
    squares = np.bincount(cells // width, counts.astype(np.float64) ** 2, len(texts))
    return words.dictionary, cells, counts, np.sqrt(squares)


def _cosine(dots: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.divide(dots.astype(np.float64), scale, out=np.zeros(len(dots)), where=scale > 0)


def term_similarities(lowered: Column, themes: Sequence) -> Column:
    """`term_similarity` of a lower-case text to each of a bounded list of rows with `terms` and `norm`, as an
    array. Tokens of an Arrow batch are counted together, and no array of them leaves the task."""
    given = [
        (pa.array([t["term"] for t in r["terms"] or []], pa.string()), [t["n"] for t in r["terms"] or []], r["norm"] or 0.0)
        for r in themes
    ]

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def to_all(texts: pa.Array) -> pa.Array:
        known, cells, counts, norms = _counted(texts)
        width, n = max(len(known), 1), len(texts)
        rows, tokens_of = cells // width, cells % width
        out = np.zeros((n, len(given)))
        for k, (terms, times, norm) in enumerate(given):
            weights = np.zeros(width)
            for place, n_times in zip(pc.index_in(terms, value_set=known).to_pylist(), times):
                if place is not None:
                    weights[place] = n_times
            hit = np.flatnonzero(weights[tokens_of])
            dots = np.bincount(rows[hit], weights[tokens_of[hit]] * counts[hit], n)
            out[:, k] = _cosine(dots, norms * norm)
        offsets = np.arange(n + 1, dtype=np.int32) * len(given)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return to_all(lowered)


@F.arrow_udf(T.DoubleType())
def term_similarity_of_text(lowered: pa.Array, terms: pa.Array, terms_norm: pa.Array) -> pa.Array:
    """`term_similarity` of pairs of a lower-case text and a `term_counts` vector. A text that comes in several
    pairs of a batch is counted once."""
    texts = pc.fill_null(lowered, "").dictionary_encode()
    known, cells, counts, norms = _counted(texts.dictionary)
    width, n = max(len(known), 1), len(lowered)
    row_of = texts.indices.to_numpy().astype(np.int64)
    sizes = pc.fill_null(pc.list_value_length(terms), 0).to_numpy()
    pairs = np.repeat(np.arange(n), sizes)
    flat = terms.flatten()
    token = pc.fill_null(pc.index_in(flat.field("term"), value_set=known), -1).to_numpy()
    times = flat.field("n").to_numpy().astype(np.float64)
    met = np.flatnonzero(token >= 0)
    wanted = row_of[pairs[met]] * width + token[met]
    place = np.minimum(np.searchsorted(cells, wanted), max(len(cells) - 1, 0))
    held = np.flatnonzero(cells[place] == wanted) if len(cells) else np.zeros(0, np.int64)
    dots = np.bincount(pairs[met[held]], times[met[held]] * counts[place[held]], n)
    scale = norms[row_of] * pc.fill_null(terms_norm, 0.0).to_numpy() if n else np.zeros(0)
    return pa.array(_cosine(dots, scale), pa.float64())


def lower_tokens(text: Column) -> Column:
    return tokens(F.lower(text))


def encode(
    text: Column,
    encoder: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]],
    batch: int = fixed.MODEL_BATCH,
) -> Column:
    """Vectors from a caller's model. `encoder()` is called once per task to load it; the model
    then gets lists of at most `batch` texts."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = encoder()
        for texts in batches:
            rows = texts.to_pylist()
            out: list = []
            for i in range(0, len(rows), batch):
                out.extend([float(x) for x in v] for v in model(rows[i : i + batch]))
            yield pa.array(out, pa.list_(pa.float32()))

    return run(text)
