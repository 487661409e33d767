"""Places of matches, also of very many in one text."""

import random
import re
import time

from pyspark.sql import functions as F

from riskloom.llm import licenses, personal_data
from riskloom.llm.matches import located


def test_places_equal_those_of_finditer(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab \U0001f600", k=n)) for n in [0, 1, 2, 3, 5, 30, 200, 900] * 3]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = located(F.split("t", "a+b?", -1), F.regexp_extract_all("t", F.lit("a+b?"), F.lit(0)), context=3)
    for r in df.select("i", found.alias("m")).collect():
        text = texts[r.i]
        want = [(m.start(), m.end(), m.group()) for m in re.finditer("a+b?", text)]
        assert [(m.start, m.end, m.hit) for m in r.m] == want
        for m in r.m:
            assert text[: m.start].endswith(m.before) and text[m.end :].startswith(m.after)


def test_many_matches_in_one_text(spark):
    """Four times the matches take about four times as long."""
    docs = lambda t: spark.createDataFrame([(1, t)], "doc_id long, text string")
    spans = personal_data.personal_data(docs("a@b.cd 1.2.3.4 " * 200)).select(F.size("personal").alias("n"))
    spans.collect()
    begun = time.monotonic()
    row = personal_data.personal_data(docs("me@mail.org, " * 32_000)).select(F.size("personal").alias("n"), F.col("personal")[31_999]["start"].alias("last")).first()
    spent = time.monotonic() - begun
    assert (row.n, row.last) == (32_000, 31_999 * 13)
    begun = time.monotonic()
    found = licenses.license_scan(docs("All rights reserved. " * 24_000)).first()
    also = time.monotonic() - begun
    print(spent, also)
    assert (found.n_base, found.last_word) == (24_000, 3 * 23_999) and spent < 20 and also < 30
