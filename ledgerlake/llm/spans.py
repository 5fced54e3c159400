"""Byte ranges of words in batches of texts, found without a Python loop."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


@dataclass(frozen=True)
class Texts:
    """Texts end to end: ``data`` (bytes) and the ``bounds`` of each."""

    data: np.ndarray
    bounds: np.ndarray

    @staticmethod
    def of(texts: pa.Array, before: str = "") -> Texts:
        """A null text has no bytes; ``before`` stands in front of each other one."""
        texts = texts.cast(pa.large_string())
        if before:
            texts = pc.binary_join_element_wise(pa.scalar(before, pa.large_string()), texts, pa.scalar("", pa.large_string()))
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
        return Texts(data, bounds - bounds[0])


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def of_bytes(*values: int) -> np.ndarray:
    """A table by byte that holds True at ``values``."""
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


def runs(apart: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not ``apart``; no run crosses a text's bound."""
    inside = ~apart
    edge = np.zeros(len(inside) + 1, bool)
    edge[bounds] = True
    starts = inside & np.r_[True, apart[:-1]] if len(inside) else inside
    starts |= inside & edge[:-1]
    ends = inside & np.r_[apart[1:], True] if len(inside) else inside
    ends |= inside & edge[1:]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """The byte ranges, which ascend, do not overlap and are not empty, as a dictionary of binary values."""
    kept = np.zeros(len(data) + 1, np.int8)
    kept[starts] += 1
    kept[ends] -= 1
    own = data[np.cumsum(kept[:-1]) > 0]
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(own)])
    return values.dictionary_encode()


def text_of_each(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The number of the text that each range starts in."""
    return np.searchsorted(bounds, starts, side="right") - 1
