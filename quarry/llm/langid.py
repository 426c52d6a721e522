"""Language identification with a string kernel.

A text is the set of its character runs of 1 to 4 (blended spectrum, presence
only), hashed into ``DIMENSIONS`` places; letters are lower-cased, all else
reads as one blank.  The kernel of two texts is the number of places they share
over the geometric mean of their sizes.  ``LANDMARKS`` texts span the Nyström
approximation, and one ridge regression per language (one against the rest) is
fitted on its features.  The kernel is linear in a text's presence vector, so
landmarks, Nyström map and weights fold into one matrix, and a batch of texts is
scored by one matrix product.

Learning uses a bounded sample: about ``SAMPLE`` rows in all, as many of each
language, those with the smallest id hashes.  Prediction reads whole texts.

Cases: null texts and texts without a letter are ``und`` with score 0; ties go
to the language first in the alphabet; without a row to learn from everything is
``und``; a repeated row is predicted like any other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

DIMENSIONS, LONGEST = 1 << 15, 4
SAMPLE, LANDMARKS, LANGUAGES = 2000, 240, 256  # rows learnt from, landmarks, languages at most
RIDGE, SHARP = 0.05, 4.0
UNKNOWN = "und"
PLACES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


@dataclass
class Model:
    languages: list[str]
    matrix: np.ndarray  # DIMENSIONS x languages
    offset: np.ndarray


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def presence(text: str | None, letter: np.ndarray) -> np.ndarray | None:
    """Places of the text's runs (repeats included); None without a letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letter[code]
    if not is_letter.any():
        return None
    code = np.where(is_letter, code, np.uint32(32))
    keep = np.ones(len(code), bool)
    keep[1:] = is_letter[1:] | is_letter[:-1]  # one blank between words
    code = np.concatenate([[32], code[keep], [32]]).astype(np.uint32)
    out, x = [], np.zeros(len(code), np.uint32)
    for n in range(min(LONGEST, len(code))):
        x = x[: len(code) - n] + code[n:] * np.uint32(PLACES[n])
        y = x ^ (x >> np.uint32(15))
        y = y * np.uint32(0x2C1B3C6D)
        out.append((y ^ (y >> np.uint32(12))) * np.uint32(PLACES[n]) >> np.uint32(17))
    return np.concatenate(out)


def fit(rows: list[tuple[str, bytes]], languages: list[str]) -> Model:
    """A model of (language, packed presence) rows."""
    bits = np.unpackbits(np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
    labels = np.array([languages.index(r[0]) for r in rows])
    share = max(1, LANDMARKS // len(languages))
    marks = np.concatenate([np.flatnonzero(labels == k)[:share] for k in range(len(languages))])
    size = np.sqrt(np.maximum(bits.sum(axis=1), 1.0))
    landmark = bits[marks] / size[marks][:, None]
    value, vector = np.linalg.eigh((landmark @ landmark.T).astype(np.float64))
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])  # Nyström map
    phi = ((bits @ landmark.T) / size[:, None]).astype(np.float64) @ root
    target = np.where(labels[:, None] == np.arange(len(languages)), 1.0, -1.0)
    weight = 1.0 / np.bincount(labels, minlength=len(languages))[labels]  # languages count alike
    total = weight.sum()
    mean, centre = (weight @ phi) / total, (weight @ target) / total
    x, y = (phi - mean) * np.sqrt(weight)[:, None], (target - centre) * np.sqrt(weight)[:, None]
    ridge = np.linalg.solve(x.T @ x + RIDGE / len(rows) * total * np.eye(x.shape[1]), x.T @ y)
    return Model(languages, (landmark.T.astype(np.float64) @ root @ ridge).astype(np.float32), centre - mean @ ridge)


def train(docs: DataFrame) -> Model | None:
    """Learn from labelled documents whose crc32(doc_id) mod 5 is not 0."""
    spark = docs.sparkSession
    rows = (
        common.narrow(docs, doc_id="long", lang="string", text="string")
        .filter("doc_id is not null and lang is not null").filter(common.id_remainder("doc_id", 5) != 0)
        .withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return None
    each = max(8, SAMPLE // len(counts))
    # twice the wanted share by hash, so that enough are left; a table of at most LANGUAGES rows
    limits = spark.createDataFrame([(k, int(min(1.0, 2 * each / n) * (1 << 30))) for k, n in counts.items()], "lang string, below long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = letters()
        for b in batches:
            found = []
            for text in b.column("text").to_pylist():
                at = presence(text, letter)
                if at is None:
                    found.append(None)
                else:
                    row = np.zeros(DIMENSIONS, bool)
                    row[at] = True
                    found.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("place"), b.column("doc_id"), pa.array(found, pa.binary())], ["lang", "place", "doc_id", "bits"])

    sample = rows.join(F.broadcast(limits), "lang").filter("place < below").select("lang", "place", "doc_id", "text")
    got = sample.mapInArrow(run, "lang string, place long, doc_id long, bits binary").filter("bits is not null").toArrow().to_pylist()
    got.sort(key=lambda r: (r["lang"], r["place"], r["doc_id"], r["bits"]))
    taken: dict[str, list[tuple[str, bytes]]] = {}
    for r in got:
        held = taken.setdefault(r["lang"], [])
        if len(held) < each:
            held.append((r["lang"], r["bits"]))
    return fit([x for k in sorted(taken) for x in taken[k]], sorted(taken)) if taken else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    held = docs.sparkSession.sparkContext.broadcast(astuple(model) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = letters()
        m = Model(*held.value) if held.value else None
        for b in batches:
            texts = b.column("text").to_pylist()
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for lo in range(0, len(texts) if m else 0, 128):
                rows = np.zeros((min(128, len(texts) - lo), DIMENSIONS), np.float32)
                full = np.zeros(len(rows), bool)
                for i in range(len(rows)):
                    at = presence(texts[lo + i], letter)
                    if at is not None:
                        rows[i, at] = 1.0
                        full[i] = True
                margin = SHARP * ((rows @ m.matrix) / np.sqrt(np.maximum(rows.sum(axis=1), 1.0))[:, None] + m.offset)
                odds = np.exp(margin - margin.max(axis=1, keepdims=True))
                odds /= odds.sum(axis=1, keepdims=True)
                best = odds.argmax(axis=1)
                for i in np.flatnonzero(full).tolist():
                    langs[lo + i], scores[lo + i] = m.languages[best[i]], odds[i, best[i]]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = common.narrow(docs, doc_id="long", text="string").withColumn("held_out", common.id_remainder("doc_id", 5) == 0)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
