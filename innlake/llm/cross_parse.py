"""Language identification by cross-parsing.

Each language has a suffix automaton of a bounded sample of its labelled text.
A text is cut, from left to right, into the longest phrases that occur in the
sample; the fewer phrases it needs, the nearer the language. Counts are
normalised by the sample's size: phrases * log2(sample bytes) / text bytes is
an estimate of the cross-entropy in bits a byte.

All texts of a batch are parsed side by side, SEGMENT bytes of each at a time,
so that a step of the automata is one numpy gather over all of them.

Read are lower-cased letters; everything else counts as one space. Defined
results: null text, or text without a letter, is `und` with score 0; ties go to
the language whose name sorts first; if nothing is labelled, every text is
`und`; rows repeated get the same answer; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from innlake.llm import units
from innlake.llm.anchors import in_slices
from innlake.llm.memory import released

UNDETERMINED = "und"
#: Bound of the sample: bytes of normalised text a language, and rows it is drawn from.
SAMPLE_BYTES = 32_000
SAMPLE_ROWS = 64
SEGMENT = 1024
#: Rows that a worker lower-cases and parses at once.
SLICE_ROWS = 1024
_LANES = 4096
_BREAK = 0x20

_letter = np.ones(256, bool)
_letter[:128] = False
_letter[97:123] = True


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with single spaces in between, of lower-cased UTF-8 texts."""
    letter = _letter[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first byte after a letter stands for the gap
    heads = offsets[:-1][offsets[:-1] < len(data)]
    keep[heads] = letter[heads]
    places = np.concatenate([[0], np.cumsum(keep)])
    return np.where(letter, data, np.uint8(_BREAK))[keep], places[offsets]


def automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton; state 0 is the root."""
    follow: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text:
        current = len(follow)
        follow.append({})
        size.append(size[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and c not in follow[state]:
            follow[state][c] = current
            state = link[state]
        if state >= 0:
            other = follow[state][c]
            if size[state] + 1 == size[other]:
                link[current] = other
            else:
                copy = len(follow)
                follow.append(dict(follow[other]))
                size.append(size[state] + 1)
                link.append(link[other])
                while state >= 0 and follow[state].get(c) == other:
                    follow[state][c] = copy
                    state = link[state]
                link[other] = link[current] = copy
        last = current
    return follow


@dataclass
class Parser:
    """Automata of all languages in one table.

    steps[state + code] is the next state; its lowest bit says that a phrase ended
    before this byte. States are multiples of the row length.
    """

    languages: list[str]
    weights: np.ndarray
    roots: np.ndarray
    codes: np.ndarray
    steps: np.ndarray

    @classmethod
    def fit(cls, samples: dict[str, bytes]) -> Parser:
        languages = sorted(samples)
        used = sorted({c for s in samples.values() for c in s})
        codes = np.zeros(256, np.int32)  # 0: a byte that no sample has
        codes[used] = np.arange(1, len(used) + 1)
        row = len(used) + 1
        tables, roots, base = [], [], 0
        for name in languages:
            follow = automaton(samples[name])
            first = follow[0]
            dead = base + len(follow)  # behind a byte that the sample lacks: a phrase of its own
            table = np.full((len(follow) + 1, row), dead * row * 2 + 1, np.int64)
            for c, state in first.items():
                table[:, codes[c]] = (base + state) * row * 2 + 1
            table[0] = dead * row * 2
            for state, out in enumerate(follow):
                for c, after in out.items():
                    table[state, codes[c]] = (base + after) * row * 2
            roots.append(base * row)
            base += len(follow) + 1
            tables.append(table.ravel())
        steps = np.concatenate(tables) if tables else np.zeros(0, np.int64)
        weights = np.array([math.log2(max(2, len(samples[x]))) for x in languages])
        return cls(languages, weights, np.array(roots, np.int64), codes,
                   steps.astype(np.int32) if len(steps) * 2 < 1 << 31 else steps)

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases needed, by text and language; a segment's start begins a phrase."""
        sizes = np.diff(offsets)
        n = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(sizes)), n)
        begin = units.ragged(np.zeros(len(n), np.int64), n) * SEGMENT + np.repeat(offsets[:-1], n)
        length = np.minimum(SEGMENT, np.repeat(offsets[1:], n) - begin)
        order = np.argsort(-length, kind="stable")
        found = np.zeros((len(sizes), len(self.languages)), np.int64)
        codes = self.codes[data]
        for at in range(0, len(order), _LANES):
            lanes = order[at: at + _LANES]
            counts = self._lanes(codes, begin[lanes], length[lanes])
            np.add.at(found, owner[lanes], counts.T)
        return found

    def _lanes(self, codes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        longest = int(length[0])
        table = np.zeros((longest, len(begin)), np.int32)
        at = units.ragged(np.zeros(len(begin), np.int64), length)
        table[at, np.repeat(np.arange(len(begin)), length)] = codes[units.ragged(begin, length)]
        state = np.repeat(self.roots.astype(self.steps.dtype)[:, None], len(begin), axis=1)
        counts = np.zeros(state.shape, np.int32)
        # Lanes are sorted by length: the live ones are the first.
        live = np.searchsorted(-length, -np.arange(longest), side="left")
        for t in range(longest):
            k = live[t]
            step = self.steps[state[:, :k] + table[t, :k]]
            counts[:, :k] += step & 1
            state[:, :k] = step >> 1
        return counts + 1  # the phrase open at the end

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score) of normalised texts; the score is one minus best over second best."""
        n = len(offsets) - 1
        if not self.languages:
            return np.zeros(n, np.int64), np.zeros(n)
        bits = self.phrases(data, offsets) * self.weights
        best = bits.argmin(axis=1)
        if len(self.languages) == 1:
            return best, np.ones(n)
        two = np.partition(bits, 1, axis=1)
        return best, np.clip(1 - two[:, 0] / np.maximum(two[:, 1], 1e-12), 0, 1)


def _lowered(texts: pa.Array) -> pa.Array:
    """Lower-cased UTF-8; null for null, and for a text without a letter."""
    some = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False)
    return pc.if_else(some, pc.utf8_lower(texts), pa.scalar(None, texts.type)).cast(pa.binary())


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_bytes: int = SAMPLE_BYTES,
        sample_rows: int = SAMPLE_ROWS) -> Parser:
    """Learns from at most sample_bytes of the texts of each language, drawn by the texts' hashes."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang).alias("lang")).agg(
        F.count("*").alias("n")).collect()}
    if not counts:
        return Parser.fit({})
    rank = F.shiftrightunsigned(F.xxhash64(F.col(text)), 11) / float(1 << 53)
    share = F.create_map(*[x for name, n in counts.items() for x in (F.lit(name), F.lit(4.0 * sample_rows / n))])
    drawn = rows.filter(rank < share[F.col(lang)]).select(
        F.col(lang).alias("lang"), rank.alias("rank"), F.substring(text, 1, sample_bytes).alias("text"))
    texts: dict[str, list[tuple[float, str]]] = {name: [] for name in counts}
    for r in drawn.distinct().collect():
        texts[r["lang"]].append((r["rank"], r["text"]))
    missing = [name for name, found in texts.items() if not found]
    for name in missing:  # the draw missed a language of few rows
        first = rows.filter(F.col(lang) == name).select(F.col(text).alias("text")).orderBy(F.xxhash64("text")).first()
        texts[name].append((0.0, first["text"][:sample_bytes]))
    samples = {}
    for name, found in texts.items():
        raw = " ".join(t for _, t in sorted(found)).lower().encode()
        clean, _ = normalised(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        samples[name] = clean.tobytes()[:sample_bytes]
    return Parser.fit(samples)


def predict(docs: DataFrame, parser: Parser, text: str = "text") -> DataFrame:
    """docs with lang_pred and score; columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(parser)
    own = docs.columns
    names = [f"c{i}" for i in range(len(own))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(own, names)])
    place = names[own.index(text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in in_slices(batches, SLICE_ROWS):
            low = _lowered(batch.column(place))
            data, offsets = units.flat(low.fill_null(b""))
            known = low.is_valid().to_numpy(zero_copy_only=False)
            langs, scores = [], []
            for first, part, places in units.chunks(data, offsets):
                best, score = model.predict(*normalised(part, places))
                use = known[first: first + len(best)] & bool(model.languages)
                langs += [model.languages[b] if u else UNDETERMINED for b, u in zip(best, use)]
                scores.append(np.where(use, score, 0.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                names=[*names, "lang_pred", "score"])

    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(released(run), schema).toDF(*own, "lang_pred", "score")


def _fold(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all `documents`, learned from four of five hash folds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    parser = fit(docs.filter(_fold() != 0))
    held = F.coalesce(_fold() == 0, F.lit(False)).alias("held_out")
    return predict(docs.select("doc_id", "text", held), parser).select("doc_id", "held_out", "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without text or letters go. A missing label is filled in."""
    found = predict(docs, fit(docs.filter(_fold() != 0)))
    kept = found.filter(F.col("lang_pred") != UNDETERMINED)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)
