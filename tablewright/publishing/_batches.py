"""Batches of a given size, whatever the frames that they arrive in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd


def batches_of(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """The rows of ``frames`` in pieces of ``size``; only the last may be shorter."""
    held: list[pd.DataFrame] = []
    count = 0
    for frame in frames:
        while count + len(frame) >= size:
            taken = size - count
            yield pd.concat([*held, frame.iloc[:taken]], ignore_index=True)
            frame, held, count = frame.iloc[taken:], [], 0
        if len(frame):
            held.append(frame)
            count += len(frame)
    if held:
        yield pd.concat(held, ignore_index=True)
