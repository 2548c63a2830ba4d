"""What goes to a classifier: an image of fitting size as a data URL, by a call it understands. Encoding and calling are injected."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.operators.pages import LEAST_SHORT_EDGE, MOST_LONG_EDGE

#: The limit of a data URL, the first quality, what is tried when it is exceeded.
MOST_BYTES, QUALITY, LOWER_QUALITIES, LOWER_SCALES = 4_000_000, 92, (80, 65), (0.75, 0.5)


def data_url(content: bytes, kind: str = "image/jpeg") -> str:
    return f"data:{kind};base64,{base64.b64encode(content).decode('ascii')}"


def data_url_column(content: Column, kind: str = "image/jpeg") -> Column:
    """The same for a binary column, on the JVM; null stays null."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.base64(content))


def image_size(width: int, height: int) -> tuple[int, int]:
    """Small short edges grow, then long edges above the limit shrink; at least one pixel."""
    grown = max(1.0, LEAST_SHORT_EDGE / min(width, height))
    scale = MOST_LONG_EDGE / max(width, height) if max(width, height) * grown > MOST_LONG_EDGE else grown
    return (width, height) if scale == 1 else _scaled(width, height, scale)


def _scaled(width: int, height: int, scale: float) -> tuple[int, int]:
    return max(1, round(width * scale)), max(1, round(height * scale))


def attempts(width: int, height: int) -> Iterator[tuple[int, int, int]]:
    """(width, height, quality) to try, in order: the full size with falling quality, then smaller sizes with the lowest."""
    full = image_size(width, height)
    for quality in (QUALITY, *LOWER_QUALITIES):
        yield *full, quality
    for scale in LOWER_SCALES:
        yield *_scaled(*full, scale), LOWER_QUALITIES[-1]


def fitting_url(encode: Callable[[int, int, int], bytes], width: int, height: int, most: int = MOST_BYTES) -> str:
    """The data URL of the first attempt that is not too long; `encode` gives the image of a size and quality."""
    for attempt in attempts(width, height):
        url = data_url(encode(*attempt))
        if len(url) <= most:
            return url
    raise ValueError(f"the image does not fit in {most} bytes")


class FirstAccepted:
    """Calls the first of several forms of a call that the callee's signature accepts, and stays with it.

    A form is refused by a TypeError. Once one has worked, its errors are errors.
    """

    def __init__(self, forms: Sequence[tuple[str, Callable[..., Any]]]):
        self.forms, self.chosen = list(forms), None

    def __call__(self, *given: Any) -> Any:
        refused = None
        for name, form in self.forms if self.chosen is None else [f for f in self.forms if f[0] == self.chosen]:
            try:
                answer = form(*given)
            except TypeError as e:
                if self.chosen is not None:
                    raise
                refused = e
                continue
            self.chosen = name
            return answer
        raise TypeError(f"no form of the call is accepted: {refused}") from refused
