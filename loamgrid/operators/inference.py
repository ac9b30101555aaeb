"""Prediction over tiles with any model: windows, averaged scores, class and margin."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.classes import NON_SOIL, SOIL
from .tiles import window_starts


def slide(image: np.ndarray, predict: Callable[[np.ndarray], np.ndarray], crop: int, stride: int, classes: int) -> np.ndarray:
    """Mean logits (classes, h, w) over windows; predict takes (bands, crop, crop) and returns (classes, crop, crop)."""
    _, h, w = image.shape
    total, n = np.zeros((classes, h, w)), np.zeros((h, w))
    for y in window_starts(h, crop, stride):
        for x in window_starts(w, crop, stride):
            at = (slice(y, min(y + crop, h)), slice(x, min(x + crop, w)))
            total[(slice(None), *at)] += predict(image[(slice(None), *at)])
            n[at] += 1
    if not n.all():
        raise ValueError("windows leave pixels out")
    return total / n


def class_and_margin(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = np.exp(logits - logits.max(0))
    p /= p.sum(0)
    return logits.argmax(0).astype(np.uint8), np.abs(p[SOIL].max(0) - p[NON_SOIL].max(0)).astype(np.float32)


def infer(tiles: DataFrame, predict: Callable[[np.ndarray], np.ndarray], bands: int = 3, crop: int = 512, stride: int = 512, classes: int = 18) -> DataFrame:
    """tiles(tile_id, height, width, data: bands as unsigned bytes, one after the other) with cls (bytes) and margin
    (32-bit floats). Each tile is predicted by itself in one scan; predict is sent to the executors."""
    schema = pa.schema([("tile_id", pa.int64()), ("height", pa.int32()), ("width", pa.int32()), ("cls", pa.binary()), ("margin", pa.binary())])

    def run(batches):
        for batch in batches:
            out = []
            for tile, h, w, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cls, margin = class_and_margin(slide(np.frombuffer(data, np.uint8).reshape(bands, h, w), predict, min(crop, h), stride, classes))
                out.append((tile, h, w, cls.tobytes(), margin.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    return tiles.select("tile_id", "height", "width", "data").mapInArrow(run, "tile_id long, height int, width int, cls binary, margin binary")
