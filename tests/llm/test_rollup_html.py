"""Compaction beside new batches, and pages of awkward markup."""

import time

import pytest

from paceline.llm import html_text, token_rollup

CHANGES = "source string, lang string, tokenizer string, docs long, tokens long"


def batch(spark, tokens):
    return spark.createDataFrame([("a", "en", "v1", 1, tokens)], CHANGES)


def total(rollup):
    return [(r["docs"], r["tokens"]) for r in rollup.totals().collect()]


def test_a_batch_committed_during_compaction_counts_once(spark, tmp_path, monkeypatch):
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "r"))
    rollup.apply("one", batch(spark, 10))
    plain = token_rollup.TokenRollup._totals

    def late(self, commits):  # a batch commits after compaction has read which batches there are
        monkeypatch.setattr(token_rollup.TokenRollup, "_totals", plain)
        token_rollup.TokenRollup(spark, self.path).apply("late", batch(spark, 5))
        return plain(self, commits)

    monkeypatch.setattr(token_rollup.TokenRollup, "_totals", late)
    rollup.compact()
    assert total(rollup) == [(2, 15)]
    assert not rollup.apply("one", batch(spark, 10)) and not rollup.apply("late", batch(spark, 5))
    rollup.compact()
    assert total(rollup) == [(2, 15)]


@pytest.mark.parametrize("page", ["<p>x" + "</q>" * 100_000, "<div>" * 50_000 + "word" + "</q>" * 50_000, "<aside>x" * 50_000,
                                  "<div>" * 50_000 + "</div>" * 50_000, "<article><aside class='ad'>" * 20_000 + "x"])
def test_odd_markup_is_read_in_linear_time(page):
    began = time.time()
    html_text.main_text(page, html_text.trained_tree())
    assert time.time() - began < 10


def test_a_page_of_one_short_paragraph_is_its_text():
    tree = html_text.trained_tree()
    assert html_text.main_text("<html><body><p>One short&nbsp;paragraph.</p></body></html>", tree) == "One short paragraph."
    page = "<nav><a href=x>Home</a></nav><p>Two words.</p><footer>© someone</footer>"
    assert html_text.main_text(page, tree) == "Two words."
    assert html_text.main_text("<nav><a href=x>Home</a></nav><footer>© someone</footer>", tree) == ""


def test_parts_lend_their_sureness_to_what_they_hold():
    page = "<div class='sidebar'><div><p>beside</p></div></div><div class='sidebar'><article><p>main</p></article></div>"
    assert [(b.text, b.boiler > 0) for b in html_text.blocks(page)] == [("beside", True), ("main", False)]
