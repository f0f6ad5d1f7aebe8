"""Windows that many benchmark items share."""

import random

import pytest
from pyspark.sql import functions as F

from paceline.llm import decontaminate

PHRASE = "answer the following question about the passage below in one short sentence"


def tables(spark):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in ("lo", "mi", "ra", "te", "su", "vo") for b in ("ban", "cel", "dor", "fim", "gut", "hap", "jer", "kon")]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [f"{PHRASE} {say(rng.randrange(14, 30))} {rng.randrange(100)} km" for _ in range(60)]
    items += [f"{PHRASE} {say(3)}" for _ in range(20)]  # mostly common windows
    items += [say(20), say(9), say(4)]
    docs = [f"{say(20)}. {PHRASE}, {say(30)}" for _ in range(150)]
    docs += [f"{say(15)} {rng.choice(items)} {say(10)}" for _ in range(40)]
    for item in rng.sample(items[:60], 20):  # the tail alone, and the item with a word put in
        words = item.split()
        docs += [f"{say(8)} {' '.join(words[9:])} {say(5)}", f"{say(8)} {' '.join(words[:14])} {say(1)} {' '.join(words[14:])}"]
    docs += [None, "", PHRASE]
    return (spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
            spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))


def test_common_windows_change_no_result(spark):
    docs, items = tables(spark)
    found = {common: sorted(tuple(r) for r in decontaminate.leaks(docs, items, "doc_id", common=common).collect())
             for common in (1, 10**9)}
    assert found[1] == found[10**9] and len(found[1]) > 60
    held = {d for d, _, _ in found[1]}
    assert len([d for d in held if d >= 150]) >= 70


def test_documents_with_nothing_but_a_common_phrase_meet_no_item(spark):
    docs, items = tables(spark)
    docs, items = docs.where("doc_id < 150").withColumn("text", F.concat(F.lit(f"so {PHRASE} then "), "text")), items.where("item_id < 60")
    docs = docs.withColumn("text", F.expr(f"replace(text, '{PHRASE},', 'no more')"))
    windows = decontaminate.template_windows(items, "item_id", 8)
    marked = decontaminate.waiting_windows(windows, 0.5, 16).cache()
    assert marked.where("waits").select("item_id").distinct().count() == 60
    found = decontaminate.template_windows(docs, "doc_id", 8, [(8, False), (8, True)], decontaminate._bitmap(windows))
    found = found.select("doc_id", "place", "window", "slots")
    item = marked.select("item_id", F.col("place").alias("at"), "width", "literal", "window", "waits")
    assert found.join(item, "window").count() > 150 * 60
    assert decontaminate.matches(found, item, "doc_id").count() == 0


@pytest.mark.parametrize("rows", [[], [(None, PHRASE)], [(1, None)]])
def test_without_items_all_documents_are_clean(spark, rows):
    docs = spark.createDataFrame([(1, PHRASE)], "doc_id long, text string")
    assert decontaminate.leaks(docs, spark.createDataFrame(rows, "item_id long, text string"), "doc_id").count() == 0
