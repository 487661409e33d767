"""Expressions on flattened rasters: a pixel array in (row, column, channel) order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Per-channel means (blue, green, red) of the pretrained network's training images.
PRETRAINED_MEANS = (103.939, 116.779, 123.68)

# Class names in label order.
CLASS_NAMES = (
    "Avión", "Coche", "Pájaro", "Gato", "Ciervo",
    "Perro", "Rana", "Caballo", "Barco", "Camión",
)


def _gather(pixels: Column, size: int, pick: Callable[[Column, Column], Column]) -> Column:
    """``pick(array, position)`` for each output position.

    The array goes through an outer lambda, which evaluates it once per row even when it is an
    expression; inside the inner lambda alone it would be computed anew for every position.
    """
    positions = F.sequence(F.lit(0), F.lit(size - 1))
    rows = F.transform(F.array(pixels), lambda px: F.transform(positions, lambda i: pick(px, i)))
    return F.element_at(rows, 1)


def scale(pixels: Column, top: float = 255.0) -> Column:
    return F.transform(pixels, lambda p: p.cast("double") / F.lit(top))


def centre(pixels: Column, means: Sequence[float]) -> Column:
    """Subtract the mean of each pixel's channel."""
    table = F.array(*[F.lit(float(m)) for m in means])
    return F.transform(
        pixels, lambda p, i: p.cast("double") - F.get(table, F.pmod(i, F.lit(len(means))))
    )


def reverse_channels(pixels: Column, n_pixels: int, channels: int) -> Column:
    """RGB to BGR (or back)."""
    def pick(px: Column, i: Column) -> Column:
        channel = F.pmod(i, F.lit(channels))
        return F.get(px, i - channel + (channels - 1) - channel)

    return _gather(pixels, n_pixels * channels, pick)


def preprocess_pretrained(pixels: Column, n_pixels: int) -> Column:
    """BGR order, then centred; no scaling."""
    return centre(reverse_channels(pixels, n_pixels, 3), PRETRAINED_MEANS)


def flip_horizontal(pixels: Column, height: int, width: int, channels: int) -> Column:
    def pick(px: Column, i: Column) -> Column:
        channel = F.pmod(i, F.lit(channels))
        cell = F.floor(i / channels).cast("int")
        column = F.pmod(cell, F.lit(width))
        return F.get(px, (cell - column + (width - 1) - column) * channels + channel)

    return _gather(pixels, height * width * channels, pick)


def upsample(pixels: Column, height: int, width: int, channels: int, factor: int) -> Column:
    """Repeat every pixel ``factor`` times along both axes."""
    def pick(px: Column, i: Column) -> Column:
        channel = F.pmod(i, F.lit(channels))
        cell = F.floor(i / channels)
        x = F.floor(F.pmod(cell, F.lit(width * factor)) / factor)
        y = F.floor(F.floor(cell / (width * factor)) / factor)
        return F.get(px, ((y * width + x) * channels + channel).cast("int"))

    return _gather(pixels, height * width * channels * factor * factor, pick)


def shift(
    pixels: Column, dy: Column, dx: Column, height: int, width: int, channels: int
) -> Column:
    """Move the picture down by ``dy`` and right by ``dx`` pixels (fractions allowed).

    Values between pixels are interpolated bilinearly; positions outside take the nearest edge.
    """
    def clamp(v: Column, top: int) -> Column:
        return F.least(F.greatest(v, F.lit(0).cast("bigint")), F.lit(top).cast("bigint"))

    def pick(px: Column, i: Column) -> Column:
        channel = F.pmod(i, F.lit(channels))
        cell = F.floor(i / channels)
        y = F.floor(cell / width) - dy
        x = F.pmod(cell, F.lit(width).cast("bigint")) - dx
        top, left = F.floor(y), F.floor(x)
        fy, fx = y - top, x - left

        def at(row: Column, column: Column) -> Column:
            flat = (clamp(row, height - 1) * width + clamp(column, width - 1)) * channels
            return F.get(px, (flat + channel).cast("int")).cast("double")

        upper = at(top, left) * (1 - fx) + at(top, left + 1) * fx
        lower = at(top + 1, left) * (1 - fx) + at(top + 1, left + 1) * fx
        return upper * (1 - fy) + lower * fy

    return _gather(pixels, height * width * channels, pick)


def argmax(values: Column) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def first_label(label_array: Column) -> Column:
    """Flatten a one-element label array."""
    return F.element_at(label_array, 1)


def class_name(label: Column, names: Sequence[str] = CLASS_NAMES) -> Column:
    return F.get(F.array(*map(F.lit, names)), label.cast("int"))


def seeded_unit(row_id: Column, seed: int, purpose: str) -> Column:
    """A number in [0, 1) that depends only on the row id, the seed and the purpose."""
    key = F.concat_ws(":", F.lit(purpose), F.lit(str(seed)), row_id.cast("string"))
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double")
    return head / F.lit(4294967296.0)
