from __future__ import annotations

from ledgerwatch.llm import urls


def test_words_that_touch_other_letters_are_found(spark):
    rows = [
        (1, "http://example.com/онлайнcasino/"),
        (2, "http://example.com/éfree-downloads"),
        (3, "http://example.com/onlinecasino/"),
    ]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"))
    assert {r.page_id: (r.verdict, r.pattern_rule) for r in got.collect()} == {1: ("block", "*casino*"), 2: ("block", "free-download"), 3: ("allow", None)}
