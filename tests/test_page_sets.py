import random

import pytest

from shelfmark.sources.page_sets import PAGES, merged_bitmaps, missing_pages, page_bitmaps, page_count


@pytest.mark.parametrize("total", [1, 8, PAGES, PAGES + 1, 3 * PAGES - 5])
def test_missing_pages_of_merged_runs(spark, total):
    draw = random.Random(total)
    pages = [draw.randint(1, total + 40) for _ in range(min(total, 20_000))]
    runs = spark.createDataFrame([(p, k % 3) for k, p in enumerate(pages)] + [(None, 0), (0, 1), (-7, 2), (pages[0], 2)], "page long, run int")
    merged = merged_bitmaps(page_bitmaps(runs, "run"))
    assert merged.count() <= 1 + (total + 40) // PAGES + 1
    assert page_count(merged).first()[0] == len(set(pages))
    assert [r["page"] for r in missing_pages(merged, total).collect()] == sorted(set(range(1, total + 1)) - set(pages))


def test_of_no_pages(spark):
    merged = merged_bitmaps(page_bitmaps(spark.createDataFrame([], "page long")))
    assert page_count(merged).first()[0] == 0
    assert [r["page"] for r in missing_pages(merged, 5).collect()] == [1, 2, 3, 4, 5]
    assert missing_pages(merged, 0).count() == 0
