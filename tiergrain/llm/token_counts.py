"""Operator 3: token counts by section, from one encoding of the whole text.

A document is encoded once, so its tokens are those a model sees; encoding the
sections apart would split tokens at their borders and count too many. The
token byte lengths give every token's place, sections are intervals of
characters, and a sorted interval join assigns tokens to sections. A token that
crosses a border is allocated by an explicit rule:

* ``first``: to the section that has its first byte (default),
* ``last``: to the section that has its last byte,
* ``most``: to the section with most of its bytes, the earlier one on a tie.

Tokens outside all sections count for section -1 (``rest``), so the counts of a
document always add up to its token count.

Defined results: a null or empty text has one empty section of no tokens;
repeated rows give repeated results; texts of any length are encoded whole; an
empty table gives an empty result. No shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from tiergrain.llm.byte_bpe import read_ranks
from tiergrain.llm.common import id_text

RULES = ("first", "last", "most")


@lru_cache(maxsize=2)
def _encoder(tokens: tuple[bytes, ...], pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    ranks = {t: i for i, t in enumerate(tokens) if t}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return library, np.array([len(t) for t in tokens], dtype=np.int64)


def line_sections(text: str) -> list[tuple[int, int]]:
    """Lines as sections, each with its line feed (characters, end exclusive)."""
    out, at = [], 0
    for line in text.split("\n"):
        out.append((at, min(len(text), at + len(line) + 1)))
        at += len(line) + 1
    if len(out) > 1 and out[-1][0] == out[-1][1]:
        out.pop()           # nothing follows the last line feed
    return out


def field_sections(fields: list[str], join: str = "\n") -> tuple[str, list[tuple[int, int]]]:
    """Fields joined to one text, and each field's interval in it."""
    out, at = [], 0
    for f in fields:
        out.append((at, at + len(f)))
        at += len(f) + len(join)
    return join.join(fields), out


def attribute(lengths: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section, the tokens outside all sections last.

    ``lengths``: bytes of each token in text order. ``starts``, ``ends``: byte
    bounds of the sections, sorted and apart.
    """
    stop = np.cumsum(lengths)
    begin = stop - lengths

    def section_of(byte: np.ndarray) -> np.ndarray:
        i = np.searchsorted(starts, byte, side="right") - 1
        # an empty section shares its start with the next one, which is taken
        return np.where((i >= 0) & (byte < ends[np.maximum(i, 0)]), i, len(starts))

    first, last = section_of(begin), section_of(stop - 1)
    chosen = {"first": first, "last": last}.get(rule, first).copy()
    if rule == "most":
        for t in np.flatnonzero(first != last):      # the few tokens that cross a border
            places = section_of(np.arange(begin[t], stop[t]))
            found, count = np.unique(places, return_counts=True)
            best = found[count == count.max()]
            chosen[t] = min(best, key=lambda s: int(np.argmax(places == s)))
    return np.bincount(chosen, minlength=len(starts) + 1)


def count_tokens(docs: DataFrame, path: str, pattern: str, rule: str = "first",
                 sections: Callable[[str], list[tuple[int, int]]] = line_sections,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``section``, ``start``, ``end`` (characters), ``n_tokens``.

    Section -1 appears only if it has tokens.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}")
    ranks = docs.sparkSession.sparkContext.broadcast((tuple(read_ranks(path)), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, sizes = _encoder(*ranks.value)
        for b in batches:
            out: dict[str, list] = {n: [] for n in ("doc_id", "section", "start", "end", "n_tokens")}
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                spans = sections(text)
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                byte_of = np.concatenate([np.flatnonzero((data & 0xC0) != 0x80), [len(data)]])
                bounds = byte_of[np.array(spans, dtype=np.int64).reshape(-1, 2)]
                lengths = sizes[np.array(library.encode_ordinary(text), dtype=np.int64)]
                n = attribute(lengths, bounds[:, 0], bounds[:, 1], rule).tolist()
                rest = [(-1, None, None, n[-1])] if n[-1] else []
                for row in [(i, a, z, c) for i, ((a, z), c) in enumerate(zip(spans, n))] + rest:
                    for name, v in zip(out, (doc, *row)):
                        out[name].append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, section int, start long, end long, n_tokens long")
