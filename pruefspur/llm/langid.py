"""Language identification with bit-sliced Bloom filters of n-grams.

Each place of the filter holds a mask with one bit per language.  The masks at an n-gram's places,
and-ed, give all languages whose filters contain it, in one lookup for all languages.  A document's
bits are counted per language; from each count the hits are taken off that its filter's fill lets
through by chance, and the highest corrected count decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import quoted
from .kernels import U, mix, spans_of

#: Letters of an n-gram; a word's border counts as one at either end.
SIZES = (3, 4)
#: Places of the filter (a power of two) and places of an n-gram in it.
PLACES, HASHES = 1 << 19, 3
#: Labelled documents per language that the filters are learned from: a bound on the sample, not on
#: what is predicted.
SAMPLE = 4_000
#: An n-gram is a language's when at least this share (per mille) of its sampled documents has it.
SHARE = 5
UNKNOWN = "und"
_CHARS_AT_ONCE = 1 << 20
_FACTORS = mix(np.arange(1, 9, dtype=np.uint64))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter or a mark within words."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def grams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the texts, and the text each belongs to."""
    joined = "\x00".join(texts) + "\x00"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    stops = np.cumsum([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(stops, prepend=0))
    letter = _letters()[np.minimum(codes, 0x10FFFF)]
    # Of a run of other characters, those next to a letter stay as borders.
    wanted = letter | np.concatenate([[False], letter[:-1]]) | np.append(letter[1:], False)
    codes, owner, letter = codes[wanted].astype(np.uint64), owner[wanted], letter[wanted]
    codes[~letter] = 0
    hashes, owners = [], []
    for n in SIZES:
        if len(codes) < n:
            continue
        count = len(codes) - n + 1
        rolled = np.full(count, U(n))
        inside = np.ones(count, bool)
        for k in range(n):
            rolled += (codes[k : count + k] + U(1)) * _FACTORS[k]
            if 0 < k < n - 1:
                inside &= letter[k : count + k]
        inside &= owner[:count] == owner[n - 1 :]
        hashes.append(mix(rolled[inside]))
        owners.append(owner[:count][inside])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def places(hashes: np.ndarray) -> list[np.ndarray]:
    """The places of n-grams in the filter."""
    return [(mix(hashes + U(k)) & U(PLACES - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass(frozen=True)
class Model:
    """``languages`` in the order of their bits; ``slices`` has a row of masks of 64 languages each;
    ``chance`` is the share of foreign n-grams that a language's filter lets through."""

    languages: tuple[str, ...]
    slices: np.ndarray
    chance: np.ndarray

    def counts(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Hits of each text in each language's filter."""
        at = places(hashes)
        out = np.zeros((n, len(self.languages)))
        for part, masks in enumerate(self.slices):
            found = masks[at[0]]
            for a in at[1:]:
                found = found & masks[a]
            some = found != 0
            found, of = found[some], owner[some]
            for bit in range(min(64, len(self.languages) - 64 * part)):
                out[:, 64 * part + bit] = np.bincount(of[(found >> U(bit)) & U(1) == 1], minlength=n)
        return out


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of each document, counted per batch and language."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        texts = [(t or "").lower() for t in batch.column(1).to_pylist()]
        for a, b in spans_of([len(t) + 1 for t in texts], _CHARS_AT_ONCE):
            hashes, owner = grams(texts[a:b])
            order = np.lexsort((hashes, owner))
            hashes, owner = hashes[order], owner[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            hashes, owner = hashes[new], owner[new]
            spoken = langs[a:b]
            for lang in dict.fromkeys(spoken):
                values, times = np.unique(hashes[(spoken == lang)[owner]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(times)],
                    names=["lang", "gram", "n"],
                )


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", key_col: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Filters of the languages of ``labelled``, from about ``sample`` documents of each.

    Rows with a null language or text teach nothing.  Which documents are sampled hangs on a hash of
    the key, so it is the same in every run.  To the driver come one count per language and the
    filter itself: at most ``PLACES`` masks per 64 languages.
    """
    rows = labelled.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(key_col).cast("string")).alias("_h")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(found, key=lambda s: (-found[s], s)))
    parts = -(-len(languages) // 64)
    slices = np.zeros((max(parts, 1), PLACES), np.uint64)
    if not languages:
        return Model((), slices, np.zeros(0))
    out_of = 1 << 20
    share = F.create_map(*[F.lit(x) for s, n in found.items() for x in (s, min(out_of, -(-sample * out_of // n)))])
    numbers = F.create_map(*[F.lit(x) for i, s in enumerate(languages) for x in (s, i)])
    taken = rows.filter(F.pmod("_h", F.lit(out_of)) < share[F.col("lang")])
    taken = taken.select("lang", "text", "_h")
    sizes = {r["lang"]: r["n"] for r in taken.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    least = F.create_map(*[F.lit(x) for s in languages for x in (s, max(1, -(-sizes.get(s, 0) * SHARE // 1000)))])
    grams_ = (
        taken.repartition(F.col("_h"))
        .mapInArrow(_learned, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least[F.col("lang")])
        .select(numbers[F.col("lang")].alias("lang"), "gram")
    )

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate(places(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            lang = np.tile(lang, HASHES)
            mask = (U(1) << (lang % 64).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((lang // 64).astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(mask)],
                names=["part", "place", "mask"],
            )

    filled = grams_.mapInArrow(sliced, "part int, place int, mask bigint").groupBy("part", "place").agg(F.bit_or("mask").alias("mask"))
    table = filled.toArrow()
    part, place = table["part"].to_numpy(), table["place"].to_numpy()
    slices[part, place] = table["mask"].to_numpy().view(np.uint64)
    fill = np.array([(((slices[i // 64] >> U(i % 64)) & U(1)) == 1).mean() for i in range(len(languages))])
    return Model(languages, slices, fill**HASHES)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The input with ``lang_pred`` and ``score``; input columns of these names are replaced.

    The whole text is read.  The score is the winner's corrected share of the text's n-grams, 0 to 1.  Of equal
    languages the one with more labelled documents wins, then the first by name.  A null text and one without a letter is ``und`` with score 0;
    so is every text when no language was learned.  Rows are judged each for itself.
    """
    # Arrays and names only: a broadcast value of a class of this package would ask executors for it.
    known = docs.sparkSession.sparkContext.broadcast((model.languages, model.slices, model.chance))
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*known.value)
        for batch in batches:
            texts = [(t or "").lower() for t in batch.column(0).to_pylist()]
            langs: list[str] = []
            scores: list[float] = []
            for a, b in spans_of([len(t) + 1 for t in texts], _CHARS_AT_ONCE):
                hashes, owner = grams(texts[a:b])
                n = b - a
                total = np.bincount(owner, minlength=n).astype(float)
                if not m.languages:
                    langs += [UNKNOWN] * n
                    scores += [0.0] * n
                    continue
                hits = m.counts(hashes, owner, n)
                right = (hits - total[:, None] * m.chance) / (1 - np.minimum(m.chance, 0.999))
                share = np.clip(right / np.maximum(total, 1)[:, None], 0, 1)
                best = right.argmax(axis=1)
                known_text = [any(c.isalpha() for c in t) for t in texts[a:b]]
                langs += [m.languages[i] if ok else UNKNOWN for i, ok in zip(best, known_text, strict=True)]
                scores += [float(share[r, i]) if ok else 0.0 for r, (i, ok) in enumerate(zip(best, known_text, strict=True))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=names,
            )

    # Inside the tasks columns go by number: an input column may have any name.
    names = [*[f"c{i}" for i in range(len(kept))], "lang_pred", "score"]
    work = docs.select(F.col(text_col), *[F.col(quoted(c)) for c in kept]).toDF("text", *names[:-2])
    schema = T.StructType(work.schema.fields[1:]).add("lang_pred", "string").add("score", "double")
    return work.mapInArrow(judged, schema).toDF(*kept, "lang_pred", "score")
