"""Image sizes, the ladder of attempts, data URLs, the choice of a call."""

import base64

import pytest
from pyspark.sql import functions as F

from docflow.operators import payload as p


@pytest.mark.parametrize(("size", "want"), [((1500, 2000), (1500, 2000)), ((512, 700), (1024, 1400)), ((500, 2000), (600, 2400)), ((3000, 2000), (2400, 1600)), ((1, 9000), (1, 2400))])
def test_sizes(size, want):
    assert p.image_size(*size) == want


def test_ladder():
    assert list(p.attempts(1000, 2000)) == [(1024, 2048, 92), (1024, 2048, 80), (1024, 2048, 65), (768, 1536, 65), (512, 1024, 65)]
    tried = []

    def encode(width, height, quality):
        tried.append(quality)
        return b"x" * (width * height * quality // 100)

    url = p.fitting_url(encode, 1000, 2000, 1_200_000)
    assert tried == [92, 80, 65, 65] and base64.b64decode(url.partition(",")[2]) == b"x" * (768 * 1536 * 65 // 100)
    with pytest.raises(ValueError):
        p.fitting_url(encode, 1000, 2000, 10)


def test_data_urls(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\xffabc"),), (None,)], "content binary")
    got = [r[0] for r in df.select(p.data_url_column(F.col("content"), "image/png")).collect()]
    assert got == [p.data_url(b"\x00\xffabc", "image/png"), None] and got[0].startswith("data:image/png;base64,AP9h")


def test_first_accepted():
    def refuse(x):
        raise TypeError("unexpected keyword")

    calls = p.FirstAccepted([("full", refuse), ("plain", lambda x: 1 // x)])
    assert calls(1) == 1 and calls.chosen == "plain"
    with pytest.raises(ZeroDivisionError):
        calls(0)
    with pytest.raises(TypeError):
        calls("a")
    with pytest.raises(TypeError):
        p.FirstAccepted([("full", refuse)])(1)
