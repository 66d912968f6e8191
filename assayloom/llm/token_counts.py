"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from assayloom.llm import word_bpe
from assayloom.llm.text import SLICE_BYTES, clear_of, coded_words, slices, sums, texts_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of distinct words given to the library at once.
_BATCH_BYTES = 1 << 20


def splits_at_space(definition: dict) -> bool:
    """Whether a tokenizer's ids of a text are those of its words one after the other.

    True when white space is only ever a border: the pre-tokenizer keeps matches
    of a pattern that never takes white space in, drops the rest, and no added
    token holds white space or takes it along.
    """
    steps = definition.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    first = steps[0] if steps else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    parts = [p for p in pattern.split("|") if p]
    inside = [p for p in parts if not (p.startswith("'") or p in (r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"))]
    return (
        first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
        and bool(parts) and not inside and not definition.get("post_processor")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"])
                    for t in definition.get("added_tokens", []))
    )


def byte_batches(values: list[str], limit: int = _BATCH_BYTES) -> Iterator[list[str]]:
    """Runs of values of about ``limit`` bytes, so that no batch waits for one large neighbour."""
    part, size = [], 0
    for v in values:
        if part and size + len(v) > limit:
            yield part
            part, size = [], 0
        part.append(v)
        size += len(v) + 16
    if part:
        yield part


class Encoder:
    """A tokenizer file: ids of texts by its library, and whether words can be encoded alone, and many at once."""

    def __init__(self, path: str):
        self.alone, self.words = False, None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda values: model.encode(values, num_threads=1)
            return
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        self.encode = lambda values: [e.ids for e in library.encode_batch_fast(values, add_special_tokens=False)]
        self.alone = splits_at_space(definition)
        if self.alone and word_bpe.fits(definition):
            self.words = word_bpe.WordBpe(definition)

    def by_library(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, how many of each unit)."""
        ids, counts = [np.zeros(0, "<u4")], []
        for part in byte_batches(units.to_pylist()):
            found = self.encode(part)
            counts += map(len, found)
            ids.append(np.fromiter(itertools.chain.from_iterable(found), "<u4"))
        return np.concatenate(ids), np.array(counts, np.int64)

    def of_units(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, how many of each unit); words of letters are merged together, their signs and the rest go to the library."""
        if self.words is None:
            return self.by_library(distinct)
        which, parts = word_bpe.parted(distinct)
        whole = self.by_library(distinct.filter(pa.array(~which)))
        kinds = []
        for name, of in (("before", self.by_library), ("word", self.words.encode), ("after", self.by_library)):
            values = parts.field(name)
            coded = (pc.utf8_lower(values) if name == "word" else values).dictionary_encode()
            ids, counts = of(coded.dictionary)
            at = coded.indices.to_numpy()
            kinds.append((ids, (np.cumsum(counts) - counts)[at], counts[at]))
        kinds.append((whole[0], np.cumsum(whole[1]) - whole[1], whole[1]))
        # Every unit is three runs of the ids of all kinds.
        base = np.cumsum([0] + [len(k[0]) for k in kinds])
        starts, lengths = np.zeros((len(distinct), 3), np.int64), np.zeros((len(distinct), 3), np.int64)
        for j in range(3):
            starts[which, j], lengths[which, j] = kinds[j][1] + base[j], kinds[j][2]
        starts[~which, 0], lengths[~which, 0] = kinds[3][1] + base[3], kinds[3][2]
        flat = np.concatenate([k[0] for k in kinds])
        return word_bpe.ragged(flat, starts.ravel(), lengths.ravel()), lengths.sum(axis=1)


def encode_texts(texts: pa.Array, encoder: Encoder) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, codes, ids, counts): text i is the units codes[offsets[i]:offsets[i + 1]], ids those of all units, counts how many each has.

    Units are the distinct words where words can be encoded alone (the safe
    borders of long texts are their white space), else whole texts.
    """
    if encoder.alone:
        offsets, codes, distinct = coded_words(texts)
    else:
        distinct = texts
        codes, offsets = np.arange(len(texts)), np.arange(len(texts) + 1)
    return offsets, codes, *encoder.of_units(distinct)


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    ``path`` is a public tokenizer file that every executor has. No begin, end or
    other special tokens are added, nothing is cut off. A null or empty text has
    0 bytes and 0 tokens; repeated rows are counted each. One pass, no shuffle:
    a task holds one slice of texts and the lengths of its distinct words.
    """
    def count(batches):
        encoder = Encoder(path)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                texts = texts_of(part, text)
                offsets, codes, _, counts = encode_texts(texts, encoder)
                n = sums(counts[codes], offsets)
                yield pa.RecordBatch.from_arrays(
                    [part[doc_id], pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n), pa.array(n > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    source = clear_of(docs, doc_id, text)
    kind = source.schema[doc_id].dataType.simpleString()
    return source.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
