"""The corpus operators against brute force, and on awkward input."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from paceline.llm import (common, components, decontaminate, embedding_join, html_text, licenses, mixing, pii, simhash,
                          substrings, token_rollup, toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, sources=("a", "b")):
    rows = [(i, t, "en", sources[i % len(sources)], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


AWKWARD = [None, "", "  \n\t ", "one", "One  two", "x" * 5000, "é ñ ß", "same text here", "same text here", "a b c " * 3000]


# -- PII -----------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [2, 10, 97, 1000])
def test_feistel_is_a_permutation(size):
    image = [pii.permute(v, size, b"k", b"t") for v in range(size)]
    assert sorted(image) == list(range(size))
    assert [pii.unpermute(v, size, b"k", b"t") for v in image] == list(range(size))


def test_pseudonyms_keep_format_validity_and_links():
    text = ("card 4111 1111 1111 1111 and 4111111111111111, not 4111111111111112; +1 (136) 555-7479; 10.0.0.255 but 10.0.0.256; "
            "2024-02-29 not 2023-02-29; 31.12.1999; jo.doe7@mail.example.com; 123-45-6789 not 666-45-6789; GB82 WEST 1234 5698 7654 32")
    new, found = pii.pseudonymise(text, b"key")
    assert found == {"card": 2, "phone": 1, "ipv4": 1, "date": 2, "email": 1, "ssn": 1, "iban": 1}
    for kept in ("4111111111111112", "10.0.0.256", "2023-02-29", "666-45-6789", "@mail.example.com"):
        assert kept in new
    cards = re.findall(r"card ([\d ]{19}) and (\d{16})", new)[0]
    assert cards[0].replace(" ", "") == cards[1] != "4111111111111111"
    assert pii.luhn_digit(cards[1][:-1]) == cards[1][-1]
    assert pii.iban(re.search(r"GB[\w ]{25}", new).group(), b"key") is not None
    assert pii.pseudonymise(text, b"key")[0] == new != pii.pseudonymise(text, b"other")[0]
    assert [len(x) for x in new.split(";")][1] == len(" +1 (136) 555-7479")


@pytest.mark.parametrize("text, kind, numbers", [
    ("4111 1111 1111 1111 12/27", "card", ["4111 1111 1111 1111"]),
    ("4111-1111-1111-1111 123", "card", ["4111-1111-1111-1111"]),
    ("no 7 4111 1111 1111 1111", "card", ["4111 1111 1111 1111"]),
    ("2024-02-29 4111 1111 1111 1111", "card", ["4111 1111 1111 1111", "2024-02-29"]),
    ("4111 1111 1111 1111 5500 0000 0000 0004 9", "card", ["4111 1111 1111 1111", "5500 0000 0000 0004"]),
    ("33 3782 822463 10005 12", "card", ["3782 822463 10005"]),
    ("4111111111111111 5500000000000004", "card", ["4111111111111111", "5500000000000004"]),
    ("to BE68 5390 0754 7034 EUR", "iban", ["BE68 5390 0754 7034"]),
    ("GB82 WEST 1234 5698 7654 32 PAID IN FULL", "iban", ["GB82 WEST 1234 5698 7654 32"]),
    ("AB12 BE68 5390 0754 7034 BE68 5390 0754 7034 PAID", "iban", ["BE68 5390 0754 7034"]),
    ("PAY DE89370400440532013000 NOW", "iban", ["DE89370400440532013000"]),
    ("on 12/31/2024 and 31/12/2024", "date", ["12/31/2024", "31/12/2024"]),
])
def test_numbers_beside_others_are_found(text, kind, numbers):
    new, found = pii.pseudonymise(text, b"key")
    assert found[kind] >= len([n for n in numbers if n != "2024-02-29"])
    assert len(new) == len(text) and not any(n in new for n in numbers)
    rest = text
    for n in numbers:
        rest = rest.replace(n, " " * len(n))
    assert all(b == a for a, b in zip(rest, new) if a != " ")


def test_dates_of_all_orders_stay_linked_and_distinct():
    hidden = lambda t: pii.pseudonymise(t, b"key")[0]
    y, m, d = hidden("2024-12-31").split("-")
    assert hidden("12/31/2024") == f"{m}/{d}/{y}" and hidden("31/12/2024") == f"{d}/{m}/{y}"
    assert hidden("13/13/2024") == "13/13/2024" and hidden("02/30/2024") == "02/30/2024"
    years = [f"{a:02d}/{b:02d}/2024" for a in range(1, 32) for b in range(1, 32)]
    changed = [t for t in years if hidden(t) != t]
    assert len({hidden(t) for t in changed}) == len(changed) > 580


def test_pii_table(spark):
    docs = docs_of(spark, [*AWKWARD, "mail a.b@c.org"]).withColumn("pii_found", F.lit(1))
    out = {r["doc_id"]: r for r in pii.pseudonymise_documents(docs, "k").collect()}
    assert len(out) == 11 and out[0]["text"] is None and out[1]["text"] == ""
    assert out[10]["pii_found"] == {"email": 1} and out[9]["text"] == AWKWARD[9]


# -- toxicity ------------------------------------------------------------------------------


def test_toxicity_learns_and_keeps_to_its_rows(spark):
    rng = random.Random(5)
    stems = ("vequ", "lowei")
    texts = [words(rng, 30) + (f" {rng.choice(stems)}{rng.choice('abcdef')}{i} " if i % 4 == 0 else " the ") + words(rng, 30)
             for i in range(600)]
    docs = docs_of(spark, [*texts, *AWKWARD])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    params = toxicity.ToxicityParams(buckets=1 << 12, sample_per_class=300)
    sample = toxicity.training_sample(docs, labels, params)
    assert sample.where(common.held_out()).count() == 0 and sample.count() <= 600
    out = toxicity.score_documents(docs, toxicity.fit(docs, labels, params), ["doc_id"]).collect()
    assert len(out) == 610 and all(0 <= r["score"] <= 1 for r in out)
    unseen = [r for r in out if r["doc_id"] < 600 and __import__("zlib").crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = sum((r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in unseen)
    assert right >= 0.9 * len(unseen)
    empty = toxicity.score_documents(docs.limit(0), toxicity.fit(docs, labels.limit(0), params), ["doc_id"])
    assert empty.count() == 0


def test_toxicity_reads_every_label(spark):
    docs = docs_of(spark, [f"plain w{i % 50}" for i in range(3600)])
    docs = docs.union(docs.limit(9))  # repeated ids count once
    labels = spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(3600)], "doc_id long, toxic int")
    params = toxicity.ToxicityParams(buckets=1 << 10, shard_rows=500)
    rows = toxicity.training_sample(docs, labels, params).collect()
    usable = {i for i in range(3600) if __import__("zlib").crc32(str(i).encode()) % 5}
    assert sorted(r["doc_id"] for r in rows) == sorted(usable) and len({r["shard"] for r in rows}) == 6
    fitting = toxicity.training_sample(docs, labels, params).where("not calibrating").select(
        "shard", "label_toxic", "calibrating", "text")
    seen = toxicity._counted(fitting, params)
    texts = [r for r in rows if not r["calibrating"]]
    assert [sum(r["label_toxic"] == y for r in texts) for y in (0, 1)] == seen[:, 0].tolist()
    alone = np.zeros_like(seen)
    toxicity._count(alone, [r["text"].encode() for r in texts], np.array([r["label_toxic"] for r in texts]))
    assert (alone == seen).all()


def test_toxicity_of_many_shards_learns_and_reruns_agree(spark):
    rng = random.Random(8)
    texts = [words(rng, 25) + (f" {rng.choice(('vequ', 'lowei'))}{i} " if i % 4 == 0 else " the ") + words(rng, 25) for i in range(900)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(900)], "doc_id long, toxic int")
    params = toxicity.ToxicityParams(buckets=1 << 12, shard_rows=150)
    model = toxicity.fit(docs, labels, params)
    again = toxicity.fit(docs.repartition(7), labels.repartition(3), params)
    assert (toxicity._packed(model) == toxicity._packed(again)).all() and (model.thresholds == again.thresholds).all()
    held = [i for i in range(900) if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    scores = toxicity.score_texts(model, [texts[i].encode() for i in held], toxicity._language_table(params.buckets))
    assert sum((s >= 0.5) == (i % 4 == 0) for i, s in zip(held, scores)) >= 0.9 * len(held)


def test_toxicity_of_one_class_takes_nothing_for_toxic(spark):
    docs = docs_of(spark, ["some words", None, ""] * 20)
    labels = spark.createDataFrame([(i, 0) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, toxicity.ToxicityParams(buckets=1 << 10))
    assert all(r["score"] < 1e-100 for r in toxicity.score_documents(docs, model, ["doc_id"]).collect())


def test_scores_do_not_depend_on_neighbours():
    rng = random.Random(1)
    texts = [words(rng, rng.randrange(0, 40)).encode() for _ in range(50)]
    model = toxicity.train(texts, np.array([i % 2 for i in range(50)]), toxicity.ToxicityParams(buckets=1 << 10, epochs=1))
    table = toxicity._language_table(1 << 10)
    alone = [toxicity.score_texts(model, [t], table)[0] for t in texts]
    assert np.allclose(alone, toxicity.score_texts(model, texts, table), atol=1e-5)


# -- licenses ------------------------------------------------------------------------------


def test_license_rules():
    assert len(licenses.RULES) > 300
    scan = lambda t: licenses.scan_line(b" %s " % b" ".join(t.lower().encode().translate(licenses._SPACED).split()))
    assert scan("Released under the MIT License.").labels == "mit"
    assert scan("GNU Lesser General Public License v2.1").labels == "lgpl-2.1"
    assert scan("SPDX-License-Identifier: GPL-3.0-or-later").labels == "gpl-3"
    assert scan("Licensed under the Apache License, Version 2.0").labels == "apache-2"
    assert scan("CC BY-NC-SA 4.0").labels == "cc-by-nc,cc-by-nc-sa-4"  # the base phrase stays
    assert scan("mit dem Hund im Park").labels == "" and scan("").score == 0


def test_suppression_equals_comparing_all_pairs():
    rng = random.Random(3)
    for _ in range(500):
        found = []
        for _ in range(rng.randrange(25)):
            start = rng.randrange(20)
            found.append((rng.randrange(4), start, start + rng.randrange(1, 10), rng.choice("ab"), 0.5))
        kept = []
        for d in sorted(found, key=lambda d: (d[0], d[1] - d[2], d[1], d[3])):
            if not any(k[1] <= d[1] and d[2] <= k[2] for k in kept):
                kept.append(d)
        assert licenses.accepted(found) == kept


def test_spans_count_words():
    line = b" " + b" ".join([b"see", *b"released under the mit license and gpl version 2".split()] * 3) + b" "
    words_in = line.split()
    scan = licenses.scan_line(line)
    assert len(scan.spans) == 6
    for start, end, label in scan.spans:
        assert label.split("-")[0].encode() in words_in[start:end]


def test_license_table(spark):
    texts = [*AWKWARD, "Under the MIT license; under the mit-license", "Apache License, Version 2.0 cc by nc"]
    out = {r["doc_id"]: r for r in licenses.scan_documents(docs_of(spark, texts), ["doc_id"]).collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for i, t in enumerate(texts):
        assert out[i]["n_words"] == len(word.findall((t or "").lower()))
    assert (out[10]["n_base"], out[10]["first_word"], out[10]["last_word"]) == (2, 0, 4)
    assert out[11]["base_labels"] == "apache-2,cc-by-nc" and out[0]["first_word"] is None


def samples(tree):
    """Texts of a parsed pattern: each alternative once, optional parts left out and put in."""
    from re import _constants as c
    out = [""]
    for op, value in tree:
        if op is c.LITERAL:
            parts = [chr(value)]
        elif op is c.IN:
            parts = ["s"] if value[0][0] is c.LITERAL else ["x" if value[0][1] is c.CATEGORY_NOT_SPACE else "7"]
            parts = [chr(v[1]) for v in value if v[0] is c.LITERAL] or parts
        elif op is c.SUBPATTERN:
            parts = samples(value[3])
        elif op is c.BRANCH:
            parts = [s for branch in value[1] for s in samples(branch)]
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            inner = samples(value[2])
            parts = ([""] if value[0] == 0 else []) + inner
        elif op in (c.ASSERT, c.ASSERT_NOT):
            continue
        else:
            raise AssertionError(op)
        # Not all combinations: each part of the longer list meets a part of the shorter.
        n = max(len(out), len(parts))
        out = [out[k % len(out)] + parts[k % len(parts)] for k in range(n)]
    return out


def test_no_rule_is_lost_before_it_is_tried(spark, monkeypatch):
    from re import _parser
    lines = []
    for rule in licenses.RULES:
        found = [s for s in samples(_parser.parse(rule.pattern.pattern.decode())) if rule.pattern.search(f" {s} ".encode())]
        assert found, rule
        for s in found:
            assert any(w in f" {s} ".encode() for w in rule.literals), (rule, s)
        lines += found
    lines = sorted(set(lines))
    said = ["Released under Apache 2.0.", "Distributed under MPL 2.0", "EUPL 1.2", "Boost 1.0", "Artistic 2.0", "Open Database License 1.0",
            "opensource.org/licences/mit"]
    out = licenses.scan_documents(docs_of(spark, [*said, *lines]), ["doc_id"]).orderBy("doc_id").collect()
    assert [r["labels"] for r in out[:7]] == ["apache-2", "mpl-2", "eupl-1.2", "bsl-1", "artistic-2", "odbl-1", "mit"]
    monkeypatch.setattr(licenses, "rules_for", lambda line: licenses.RULES)
    for r, s in zip(out[len(said):], lines):
        scan = licenses.scan_line(f" {s} ".encode())
        assert (r["labels"], r["score"], len(r["spans"])) == (scan.labels, scan.score, len(scan.spans)) and r["labels"], s


# -- embeddings ----------------------------------------------------------------------------


def test_embedding_join_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    x = np.concatenate([base[rng.integers(0, 40, 300)] + rng.normal(scale=0.08, size=(300, 8)), np.repeat(base[:1], 30, axis=0)])
    rows = [(i, v.astype(np.float32).tolist(), int(i % 3)) for i, v in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] + [1.0] * 7, 1), (903, rows[0][1], None),
           (904, [None] + [1.0] * 7, 1), (905, [1.0], 2), (906, [float("inf")] * 8, 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    out = {r["vec_id"]: r for r in embedding_join.near_duplicates(table, block=16).collect()}
    u = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    assert linked.sum() > 300
    assert [out[i]["n_links"] for i in range(len(rows))] == linked.sum(axis=1).tolist()
    least = np.arange(len(rows))
    while True:
        new = np.minimum(least, np.where(linked, least[None, :], 10**9).min(axis=1))
        if (new == least).all():
            break
        least = new
    assert [out[i]["component_id"] for i in range(len(rows))] == least.tolist()
    assert all(out[i[0]]["n_links"] == 0 and out[i[0]]["kept"] for i in odd)
    assert embedding_join.near_duplicates(table.limit(0)).count() == 0


# -- mixing --------------------------------------------------------------------------------


def test_mix_meets_budgets(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randrange(0, 60)), "en", rng.choice(["a", "a", "a", "b", None]), 0) for i in range(400)]
    rows += [(7, None, None, "z", None), (7, "x y", None, "a", None)] + [(500, "same row", "en", "b", 1)] * 3
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mix(docs, docs.columns).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        assert r["size"] == len((r["text"] or "").split()) and 0 <= r["taken"] <= 2 * r["size"]
        s = by.setdefault(r["source"], [r["source_size"], r["target"], 0])
        s[2] += r["taken"]
    total = sum(s[0] for s in by.values())
    assert sum(s[1] for s in by.values()) == pytest.approx(1.5 * total)
    for size, target, taken in by.values():
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= 0.5 + 1e-6
    again = mixing.mix(docs.repartition(7), docs.columns)
    assert sorted(map(str, out)) == sorted(map(str, again.collect()))
    assert mixing.mix(docs.limit(0), ["doc_id", "source"]).count() == 0


# -- decontamination -------------------------------------------------------------------------


def test_decontamination_finds_parameter_variants(spark):
    item = "A train with 12 cars leaves the town of Leeds at noon and travels 60 km to reach Oslo while Leeds has 12 roads."
    variant = item.replace("12", "31").replace("Leeds", "Paris").replace("60", "75.5")
    torn = item.replace("12 cars", "31 cars")  # the same value becomes two
    rng = random.Random(4)
    texts = [words(rng, 50) + ". " + item + " " + words(rng, 20), "Then. " + variant, item.upper(), torn, words(rng, 100), *AWKWARD, item, item]
    docs = docs_of(spark, texts)
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (None, item)], "item_id long, text string")
    found = decontaminate.contaminated(docs, bench)
    hit = {r[0] for r in docs.withColumn("row", decontaminate.row_key()).join(found, F.col("row") == F.col("_row"), "left_semi")
           .select("doc_id").collect()}
    assert {0, 1, 15, 16} <= hit and not hit & {3, *range(4, 15)}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def held(spark, texts, items):
    docs, bench = docs_of(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = docs.withColumn("row", decontaminate.row_key()).join(decontaminate.contaminated(docs, bench), F.col("row") == F.col("_row"))
    return {r["doc_id"]: r["items"] for r in rows.select("doc_id", "items").collect()}


def test_edited_copies_are_found(spark):
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    items, texts, expected = [], [], []

    def plant(edited):
        expected.append(len(items) - 1)
        texts.append(" ".join([*fresh(30), *edited, *fresh(30)]))

    for n in (9, 12, 15, 16, 19, 22, 38, 60):
        w = fresh(n)
        items.append(" ".join(w))
        plant([*w[:n // 2], "other", *w[n // 2 + 1:]])
        plant([*w[:n // 2], "about", *w[n // 2:]])
        if n > 20:
            plant([*w[:n // 2], *w[n // 2 + 1:]])
            plant([*w[:n // 3], "more", *w[n // 3:2 * n // 3], "yet", *w[2 * n // 3:]])
    items.append("A train with 12 cars leaves the old town of Leeds at noon and then travels 60 km to reach the port of Oslo while "
                 "in Leeds a bus goes 5 km to meet it there")
    expected.append(len(items) - 1)
    texts.append("Then " + items[-1].replace("60 km", "about 75 km").replace("Leeds", "Paris").replace("12", "31"))
    n_copies = len(texts)
    texts += [" ".join(items[6].split()[:15] + fresh(60)), " ".join(fresh(200))]  # less than half of an item
    out = held(spark, texts, items)
    assert out == {k: [expected[k]] for k in range(n_copies)}


def test_dense_short_and_recased_items_are_found(spark):
    items = ["12 + 35 = 47, 18 + 22 = 40, 51 + 16 = 67, 33 + 29 = 62", "Anna Berg, Carl Dahl, Eva Falk, Gustav Holm, Ida Juhl",
             "Who wrote the Red Book?", "A train with 12 cars leaves the town of Leeds at noon and travels 60 km to reach Oslo while Leeds has 12 roads."]
    texts = [f"before {change(i)} after" for i in items for change in (str, str.lower, str.upper)]
    out = held(spark, [*texts, "Who wrote the blue Red Book?", "52 + 3 = 9", "Carl Berg, Anna Dahl"], items)
    assert out == {k: [k // 3] for k in range(12)}


# -- HTML ----------------------------------------------------------------------------------


def test_main_text():
    page = ("<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href=x>Home</a></nav><div class='ad'>Buy "
            "now and save a lot of money today</div><article><h1>Head&amp;line</h1><p>One <b>bold</b>\n two.<br>three</p><p>S.</p>"
            "<form>Your name</form><div class=\"comments\"><p>Great post, thanks for sharing all of this with us</p></div></article>"
            "<aside>Related things</aside><footer>&copy; x</footer></body></html>")
    tree = html_text.trained_tree()
    assert html_text.main_text(page, tree) == "Head&line\nOne bold two. three\nS."
    assert html_text.main_text("", tree) == "" and html_text.main_text("<article><p>open 1 < 2", tree) == "open 1 < 2"
    prose = "words that go on " * 12
    assert html_text.main_text(f"<body><ul><li><a>x</a><li><a>y</a></ul><p>{prose}</p><p>{prose}</p>", tree) == "\n".join([prose.strip()] * 2)


def test_a_name_word_does_not_decide_alone():
    tree = html_text.trained_tree()
    prose = ("words that go on " * 12).strip()
    article = f"<h1>The title of a story about some words</h1><p>{prose}</p><p>{prose} and on</p>"
    whole = f"The title of a story about some words\n{prose}\n{prose} and on"
    nav, foot = "<nav><a href=x>Home</a></nav>", "<footer>&copy; x</footer>"
    for around in ('<div id="content" class="has-sidebar">{}</div>', '<div class="main no-sidebar">{}</div>', '<div class="has-sidebar">{}</div>',
                   '<div class="widget"><article>{}</article></div>', '<div class="banner"><main>{}</main></div>',
                   '<section id="discussion">{}</section>', '<div aria-label="Related work">{}</div>',
                   '<article><section id="discussion">{}</section></article>', '<article><div aria-label="Related work">{}</div></article>',
                   '<article><div class="tags-page meta">{}</div></article>'):
        assert html_text.main_text(nav + around.format(article) + foot, tree) == whole, around
    for name in ("entry-header", "post-header"):
        for around in ("<article>{}</article>", "<div>{}</div>"):
            page = nav + around.format(article.replace("<h1>", f'<div class="{name}"><h1>').replace("</h1>", "</h1></div>")) + foot
            assert html_text.main_text(page, tree) == whole, (name, around)
    assert html_text.main_text(f'<div class="elementor-widget"><p>{prose}</p></div>', tree) == prose
    links = "<ul><li><a href=1>One</a></li><li><a href=2>Two more</a></li><li><a href=3>Three</a></li></ul>"
    for part in (f'<div class="related">{links}</div>', f'<div class="main-menu">{links}</div>', '<div class="ad">Buy now and save a lot today</div>',
                 f'<div class="comments"><article class="comment-body"><p>{prose}</p></article></div>', f'<div class="sidebar">{links}</div>',
                 '<div class="newsletter"><p>Sign up for our weekly letter</p></div>', f"<aside><p>{prose}</p></aside>"):
        assert html_text.main_text(f"<article>{article}</article>" + part, tree) == whole, part
        assert html_text.main_text(f"<article>{article}{part}</article>", tree) == whole, part


def test_names_have_labelled_rows_of_both_kinds():
    tree = html_text.trained_tree()
    assert all(html_text.decide(tree, r[:-1]) == bool(r[-1]) for r in html_text.DOUBTFUL)
    assert {(r[7], r[8]) for r in html_text.DOUBTFUL} == {(s, y) for s in (html_text.WEAK, html_text.NAMED) for y in (0, 1)}


def test_tree_fits_its_table():
    table = np.array(html_text.LABELLED)
    assert all(html_text.decide(html_text.trained_tree(), tuple(r[:-1])) == bool(r[-1]) for r in table)


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", "<p>" + "x " * 60), (3, "u", "<p>" + "x " * 60)],
                                  "page_id long, url string, html string")
    out = html_text.extract_pages(pages, ["page_id", "url"]).collect()
    assert sorted((r["page_id"], r["n_chars"]) for r in out) == [(1, 0), (2, 0), (3, 119), (3, 119)]


# -- SimHash -------------------------------------------------------------------------------


def brute_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    n = min(3, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(len(w) - n + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components_against_brute_force(spark):
    rng = random.Random(6)
    long = [words(rng, 300) for _ in range(10)]
    texts = AWKWARD + long + [t.replace("w1 ", "W1 ").replace(t.split()[40], "changed", 1) for t in long] + [long[0]] * 20
    out = {r["doc_id"]: r for r in simhash.simhash_components(docs_of(spark, texts), ["doc_id"]).collect()}
    prints = [brute_fingerprint(t) for t in texts]
    assert [out[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    least = list(range(len(texts)))
    for _ in texts:
        least = [min(least[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2) for p in prints]
    assert [out[i]["component_id"] for i in range(len(texts))] == least
    assert simhash.simhash_components(docs_of(spark, ["x"]).limit(0), ["doc_id"]).count() == 0


def test_anchors_cover_all_pairs_within_two_bits():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 200, dtype=np.int64) * 2 + rng.integers(0, 2, 200)
    code = simhash.AnchorCode(2)
    flips = [(1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (200, 2))]
    y = (x.view(np.uint64) ^ np.array(flips, dtype=np.uint64)).view(np.int64)
    sides = []
    for v in (x, y):
        rows, anchors = code.replicas(v)
        sides.append({i: set(anchors[rows == i].tolist()) for i in range(200)})
    assert all(sides[0][i] & sides[1][i] for i in range(200))


def test_large_groups_are_linked_like_small_ones(monkeypatch):
    rng = np.random.default_rng(1)
    fp = np.unique(np.array([int(sum(1 << int(b) for b in rng.integers(0, 12, 3))) for _ in range(150)], dtype=np.int64))
    group = np.zeros(len(fp), dtype=np.int64)
    many = dict(zip(*map(np.ndarray.tolist, simhash.stars(group, fp, 2))))
    monkeypatch.setattr(simhash, "DIRECT", 1000)
    few = dict(zip(*map(np.ndarray.tolist, simhash.stars(group, fp, 2))))
    assert many == few and many


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + k) for k in range(200)] + [(5, 5), (7, 8), (None, 3)]
    out = dict(components.connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    assert {out[i] for i in range(41)} == {0} and {out[1000 + k] for k in range(200)} == {1000}


# -- substrings ----------------------------------------------------------------------------


def brute_removed(texts, length):
    seen = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - length + 1):
            seen.setdefault(t[k:k + length], []).append((i, k))
    covered = [np.zeros(len(t), dtype=bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                covered[i][k:k + length] = True
    return covered


@pytest.mark.parametrize("group", [50_000, 3])
def test_substrings_against_brute_force(spark, group):
    rng = random.Random(8)
    fresh = lambda n: "".join(rng.choice("abcdefgé ") for _ in range(n))
    passage, other = fresh(90), fresh(70)
    texts = [fresh(rng.randrange(0, 200)) + passage[rng.randrange(0, 30):] + fresh(80) for _ in range(25)]
    near = fresh(300)
    texts += [near[:k] + "X" + near[k + 1:] for k in range(20, 280, 15)]
    texts += [other + fresh(30) + other, "ab" * 150, "z" * 200, None, "", "short", near, near, fresh(39)]
    out = {r["doc_id"]: r for r in substrings.deduplicate(docs_of(spark, texts), length=40, gram=12, group=group).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, covered in enumerate(brute_removed(raw, 40)):
        kept = np.frombuffer(raw[i], dtype=np.uint8)[~covered].tobytes()
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        assert (out[i]["n_bytes"], out[i]["n_removed"], out[i]["n_spans"], out[i]["kept_sha256"]) == (
            len(raw[i]), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()), i
    assert out[len(texts) - 2]["n_removed"] == len(near.encode())


def test_suffix_order_is_the_byte_order():
    rng = random.Random(9)
    contexts = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(4, 30))) for _ in range(80)})
    rng.shuffle(contexts)
    left = np.array([rng.randrange(0, 4) for _ in contexts])
    s = substrings.Suffixes(contexts, left)
    forward = s.sorted(np.zeros(len(contexts), dtype=int), False)
    assert [contexts[i][left[i]:] for i in forward] == sorted(c[n:] for c, n in zip(contexts, left))
    backward = s.sorted(np.zeros(len(contexts), dtype=int), True)
    assert [contexts[i][:left[i]][::-1] for i in backward] == sorted(c[:n][::-1] for c, n in zip(contexts, left))


# -- token counts --------------------------------------------------------------------------


@pytest.fixture
def vocabulary(tmp_path):
    import base64
    path = tmp_path / "bytes.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(bytes([b])) + b" %d\n" % b for b in range(256)))
    return str(path)


def test_rollup_counts_each_batch_once(spark, tmp_path, vocabulary):
    docs = docs_of(spark, AWKWARD)
    keep = ["doc_id", "source", "lang", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_key")]
    counts = token_rollup.count_tokens(docs, keep, vocabulary).cache()
    assert {r["doc_id"]: (r["words"], r["bpe"]) for r in counts.collect()} == {
        i: (len((t or "").split()), len((t or "").encode())) for i, t in enumerate(AWKWARD)}
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "rollup"))
    load = token_rollup.changes(counts, "v1", "words")
    assert rollup.totals().count() == 0 and rollup.apply("load", load) and not rollup.apply("load", load)
    rollup._write("lost", load)  # a job that died before its commit
    copies = token_rollup.copies_to_delete(counts)
    assert sorted(r["times"] for r in copies.collect()) == [1, 1]  # null and empty are one text
    assert rollup.apply("delete", token_rollup.changes(copies, "v1", "words", -F.col("times")))
    assert rollup.apply("empty", load.limit(0))
    assert rollup.apply("revise", token_rollup.revised(counts.where("doc_id = 3"), "v1", "words", F.col("words") + 5))
    total = lambda: {r["source"]: (r["docs"], r["tokens"]) for r in rollup.totals().collect()}
    n = [len((t or "").split()) for t in AWKWARD]
    expected = {"a": (5, n[0] + n[2] + n[4] + n[6] + n[8]), "b": (5, n[1] + n[3] + n[5] + n[7] + n[9] + 5)}
    gone = {r["source"]: (r["times"], r["words"]) for r in copies.collect()}
    expected = {s: (d - sum(1 for r in copies.collect() if r["source"] == s),
                    t - sum(r["words"] for r in copies.collect() if r["source"] == s)) for s, (d, t) in expected.items()}
    assert gone and total() == expected
    rollup.compact()
    assert total() == expected and not rollup.apply("delete", load)
    counts.unpersist()
