"""Operators of the training-data subpackage: brute force, and nulls, empty tables,
long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starwash.llm import (common, decontaminate, fingerprint, html_text, line_dedup, near_dedup, packing, pii, quality,
                          queries, toxicity, url_filter)

LONG = " ".join(f"word{k}" for k in range(30_000))
EDGE = [(1, None), (2, ""), (3, " \n "), (None, "no id"), (4, "same text here for all"), (4, "same text here for all"),
        (5, "same text here for all"), (6, LONG), (7, "Ünïcode 😀 text. Second sentence here.\nNext line.")]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "x", 0.5, 3) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score double, spans int")


@pytest.fixture(scope="module")
def empty(edge):
    return edge.limit(0)


def words(n, rng):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_toxicity_learns_and_defines_edge_cases(spark, edge, empty):
    rng = random.Random(1)
    texts = [(k, words(40, rng) + (" idiotic scumbag " if k % 3 == 0 else " ") + words(10, rng)) for k in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, toxicity.training_rows())
    held = toxicity.score(docs, model).filter(common.id_fold("doc_id", 4) == 2).collect()
    assert held and all(r.predicted == int(r.doc_id % 3 == 0) for r in held)
    out = toxicity.score(edge, model).collect()
    assert len(out) == len(EDGE) and all(0 <= r.score <= 1 for r in out)
    assert set(out[0].asDict()) == {"doc_id", "text", "source", "score", "spans", "predicted"}
    assert toxicity.score(empty, toxicity.train(empty, labels.limit(0))).count() == 0


def test_quality_separates_with_positive_and_unlabelled_only(spark, edge, empty):
    rng = random.Random(2)
    good = [(k, words(60, rng) + ". " + words(30, rng) + ".") for k in range(240)]
    junk = [(k, "BUY!! NOW!! " * 40) for k in range(240, 320)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(0, 240, 2)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert 0.5 < model.prior < 0.95
    out = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert min(out[k] for k in range(240)) > max(out[k] for k in range(240, 320))
    assert quality.score(edge, model).count() == len(EDGE)
    assert quality.score(empty, quality.train(empty, labels.limit(0))).count() == 0


def test_pii_base_spans_equal_plain_matching(spark):
    patterns = [re.compile(p) for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]

    def luhn(s):
        return sum(sum(divmod(int(c) * 2, 10)) if k % 2 else int(c) for k, c in enumerate(reversed(s))) % 10 == 0

    def base(text):
        out = []
        for k, p in enumerate(patterns):
            for m in p.finditer(text):
                digits = re.sub("[^0-9]", "", m.group())
                if (k == 1 and max(map(int, m.group().split("."))) > 255 or k == 2 and not (12 <= len(digits) <= 19 and luhn(digits))
                        or k == 3 and not 9 <= len(digits) <= 15):
                    continue
                out.append((m.start(), k, m.end()))
        return sorted(out)

    rng = random.Random(3)
    texts = ["".join(rng.choice("ab1234567890.@+- ()é😀") for _ in range(rng.randint(0, 120))) for _ in range(400)]
    texts += ["a@b.c_d@e.f x@y@z.com", "1.2.3.4.5.6.7.8 256.1.1.1", "4111 1111 1111 1111", "x" * 5000 + "@" + ".a" * 5000, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.base] for r in pii.detect(docs, pii.PiiModel(0.0, [], {})).collect()}
    assert all(got[k] == base(t or "") for k, t in enumerate(texts))


def test_pii_trees_add_spans_and_redact(spark, edge, empty):
    rng = random.Random(4)

    def card(valid):
        while True:
            s = "4" + "".join(rng.choice("0123456789") for _ in range(15))
            if (sum(sum(divmod(int(c) * 2, 10)) if k % 2 else int(c) for k, c in enumerate(reversed(s))) % 10 == 0) == valid:
                return s

    rows = [(k, f"text {words(5, rng)} card {card(k % 97 != 0)} and part {rng.randint(10**7, 10**8)} end") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.train(docs)
    assert model.trees and 2 in model.thresholds
    found = pii.detect(docs, model)
    one = found.filter("doc_id = 97").first()
    assert one.base == [] and [s.kind for s in one.spans] == [2]
    assert "[card]" in pii.redact(found).filter("doc_id = 97").first().text
    assert pii.detect(edge, model).count() == len(EDGE) and "score" in pii.detect(edge, model).columns
    assert pii.detect(empty, pii.train(empty)).count() == 0


def test_pii_learns_from_every_candidate(spark):
    """No document and no rare vector is left out of the counts: 25,000 texts, each with a card of its own and a mail."""
    docs = spark.range(25_000).selectExpr("id as doc_id", "concat('card 4', lpad(id, 15, '0'), repeat(' x', cast(id % 20 as int)), ' a', id, '@b.org') as text")
    got = pii.candidate_vectors(docs).groupBy("kind").sum("n").collect()
    assert {r.kind: r["sum(n)"] for r in got}[0] == 25_000 and {r.kind: r["sum(n)"] for r in got}[2] == 25_000


def test_url_filter_edge_cases(spark):
    pages = spark.createDataFrame(
        [(1, None), (2, "no scheme"), (3, "HTTP://A.Example.ORG/es/x?q"), (4, "http://example.org/en/12"), (5, "http://example.org/"),
         (6, "http://xexample.org/es/"), (7, "http://x.com/de/#a"), (8, "http://x.net/"), (8, "http://x.net/"), (9, "http:///p"),
         (10, "http://" + "a." * 5000 + "org/" + "p" * 100_000)], "page_id long, url string").withColumn("rule", F.lit("clash"))
    rules = url_filter.rule_table(spark, queries.URL_RULES)
    out = sorted((r.page_id, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect() if r.page_id != 2 or r.host == "")
    assert [x[1:] for x in out] == [
        (None, "allow"), (None, "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"),
        ("org/", "allow"), ("com/de/", "block"), (None, "allow"), (None, "allow"), (None, "allow"), ("org/", "allow")]
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, url_filter.rule_table(spark, [])).collect()} == {"allow"}


def test_packing_is_exact_and_tight(spark, edge, empty):
    path, ranks = queries.tokenizer_file(), queries.tokenizer_file("byte_bpe_50k.tiktoken")
    exact = packing.encoder(path)
    out = packing.pack_documents(edge, path, ranks, capacity=64).toPandas()
    assert len(out[out.doc_id.isna()]) == 1 and len(out[out.doc_id == 4]) == 2
    for doc, text in EDGE:
        if doc is None or doc == 4:
            continue
        ids = np.array(exact([text or ""])[0] + [2], "<u4")
        mine = out[out.doc_id == doc].sort_values("piece")
        assert mine.length.sum() == len(ids) and (mine.length[1:] == 64).all()
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(mine.start, mine.length)] == mine.ids_crc32.tolist()
    for _, seq in out.sort_values("offset").groupby("sequence_id"):
        assert seq.offset.tolist() == [0, *seq.length.cumsum()[:-1]] and seq.length.sum() <= 64
    assert packing.pack_documents(empty, path, ranks).count() == 0


def test_ranks_give_the_tokenizer_files_ids(spark, sf_small):
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    texts += ["it's <|endoftext|> 123 ½ ªº²", "tab\tnl\n\n  x", "日本語 text", "a b c"]
    path = queries.tokenizer_file()
    assert packing.encoder(path, queries.tokenizer_file("byte_bpe_50k.tiktoken"))(texts) == packing.encoder(path)(texts)


def test_best_fit_takes_the_tightest_bin():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 101, 400)
    bins, offsets = packing.best_fit_decreasing(lengths, 100)
    room, rooms = {}, []
    for n in sorted(lengths.tolist(), reverse=True):  # plain best-fit decreasing
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(100 - n)
    assert len(set(bins.tolist())) == len(rooms)
    for b in set(bins.tolist()):
        mine = sorted(zip(offsets[bins == b].tolist(), lengths[bins == b].tolist()))
        assert mine[0][0] == 0 and all(x[0] + x[1] == y[0] for x, y in zip(mine, mine[1:]))
        room[b] = 100 - sum(n for _, n in mine)
    assert min(room.values()) >= 0


def components_by_force(texts):
    sets = [set(near_dedup.shingle_hashes(t).tolist()) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


def test_near_dedup_equals_brute_force(spark, edge, empty):
    rng = random.Random(5)
    texts = []
    for _ in range(25):
        base = words(rng.choice((4, 6, 30, 200)), rng).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = base[:]
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = "edited"
            texts.append(" ".join(copy).upper())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert [got[k] for k in range(len(texts))] == components_by_force(texts)
    out = {(r.doc_id, r.component_id, r.kept, r.n_shingles) for r in near_dedup.near_duplicates(edge).collect()}
    assert {(1, 1, True, 0), (2, 2, True, 0), (3, 3, True, 0), (4, 4, True, 1), (5, 4, False, 1)} <= out
    assert any(d is None and c is None and k for d, c, k, _ in out)
    assert near_dedup.near_duplicates(empty).count() == 0


def test_html_extraction_and_minimum_cut(spark):
    page = ('<html><body class="home"><header><h1>Site</h1><nav><a href=/a>A</a></nav></header><div id="cookie-notice">We use cookies.</div>'
            '<div class="content"><h1>Title here</h1><p>First &eacute; &amp; a <a href=x>link</a>\n in it, quite long indeed.</p>'
            '<div class="ad-box">Buy now!</div><p>Second para.<p>Third<br>line<script>var x="</p>"</script></div>'
            '<div id="comments"><p>I think this is a very good article, thanks a lot.</p></div><footer>&copy; Site</footer></body></html>')
    want = "Title here\n\nFirst é & a link in it, quite long indeed.\n\nSecond para.\n\nThird line"
    rows = [(1, page), (2, None), (3, ""), (4, "<p>unclosed &amp text that runs on, and on, and on <b"), (5, "<" * 20_000), (1, page)]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    out = html_text.main_text(pages, html_text.train(pages)).collect()
    assert [r.text for r in out if r.page_id == 1] == [want] * 2 and {r.n_chars for r in out if r.page_id in (2, 3)} == {0}
    assert html_text.main_text(pages.limit(0), html_text.train(pages.limit(0))).count() == 0
    rng = random.Random(6)
    for _ in range(60):  # against all labellings
        n = rng.randint(1, 8)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 2)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(side):
            return sum(abs(o) for o, s in zip(odds, side) if (o > 0) != s) + sum(w for i, j, w in edges if side[i] != side[j])

        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert abs(cost(html_text.minimum_cut(odds, edges)) - best) < 1e-6


def test_decontamination_edge_cases(spark, edge, empty):
    rng = random.Random(7)
    item, short = words(14, rng), "only three words"
    bench = spark.createDataFrame([(1, item), (2, short), (3, None), (4, "..."), (None, item), (10, item)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, words(20, rng) + " " + item.upper() + ", " + words(3, rng)), (2, "x Only-three words y"), (3, None), (4, words(50, rng)),
         (None, short), (5, " ".join(item.split()[:9])), (6, " ".join(item.split()[1:11])), (6, short)], "doc_id long, text string").withColumn("items", F.lit(1))
    out = {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.mark(docs, bench).collect()}
    assert out == {(1, 37, 14, ("1", "10")), (2, 5, 3, ("2",)), (3, 0, 0, ()), (4, 50, 0, ()), (None, 3, 3, ("2",)), (5, 9, 0, ()),
                   (6, 10, 10, ("1", "10")), (6, 3, 3, ("2",))}
    left = decontaminate.decontaminate(docs, bench)
    assert {r.doc_id for r in left.collect()} == {3, 4, 5}
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, mode="spans").collect()}
    assert cut[2] == "x  y" and decontaminate.mark(spark.createDataFrame([(1, cut[1])], "doc_id long, text string"), bench).first().n_hit == 0
    assert decontaminate.mark(edge, bench).count() == len(EDGE) and decontaminate.mark(empty, bench).count() == 0
    assert decontaminate.mark(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_fingerprints_equal_exact_sets(spark, edge, empty):
    rng = random.Random(8)
    texts = ["", "one", "one"] + [" ".join(words(rng.randint(2, 9), rng) + "." for _ in range(rng.choice((1, 5, 60, 400)))) for _ in range(40)]
    ids = list(range(0, 10 * len(texts), 10))
    out = {r.doc_id: r for r in fingerprint.fingerprints(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")).collect()}

    def pieces(t):
        return {p.rstrip() for p in re.sub(r"(?:\n|[.?] )\s*(?=\S)", lambda m: m.group() + "￿", t).split("￿")} if t else set()

    def alike(a, b):
        return 1.0 if not a | b else len(a & b) / len(a | b)

    for k, text in enumerate(texts):
        follow = texts[(k + 1) % len(texts)]
        new, r = text[: len(text) - len(text) // 4] + follow[: len(text) // 4], out[ids[k]]
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and r.n_chars == len(text)
        assert abs(r.near_edited - alike(pieces(text), pieces(new))) < 1e-9
        assert abs(r.near_next - alike(pieces(text), pieces(follow))) < 1e-9
    assert out[10].fingerprint == out[20].fingerprint
    assert fingerprint.fingerprints(edge).count() == len(EDGE) and fingerprint.fingerprints(empty).count() == 0
    ranged = fingerprint.with_next(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"), range_rows=7).collect()
    assert {(r.doc_id, r.next_text) for r in ranged} == {(ids[k], texts[(k + 1) % len(texts)]) for k in range(len(texts))}


def test_line_dedup_removes_later_runs_only(spark, edge, empty):
    rng = random.Random(9)
    passage = ". ".join(words(12, rng).capitalize() for _ in range(5)) + "."
    clean = [words(12, rng) + ". " + words(15, rng) + ".\n" + words(9, rng) + "." for _ in range(30)]
    docs = [(k, t) for k, t in enumerate(clean)]
    docs += [(100, clean[0] + "\n" + passage), (101, "Some words before. " + passage + "\n" + clean[1][:30]), (102, words(8, rng) + ".\n" + passage),
             (103, "\n".join([words(10, rng)] * 50)), (200, clean[5])]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(out[k].text == clean[k] and out[k].n_removed == 0 for k in range(30))
    assert passage in out[100].text and clean[0] not in out[100].text
    assert passage[40:] not in out[101].text and passage not in out[102].text and out[200].text == ""
    assert out[103].n_lines == 50 and out[103].n_removed == 49
    got = line_dedup.dedup_lines(edge).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted((i or 0, t or "") for i, t in EDGE)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_lines_join_back(spark):
    rng = random.Random(10)
    texts = ["".join(rng.choice("ab.? \n!\t") for _ in range(rng.randint(0, 80))) for _ in range(300)] + ["￿ x. y"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fingerprint.lines_of(F.col("t")).alias("x")).collect()
    assert all("".join(r.x or []) == r.t for r in rows)


def test_pipeline_stages_chain(spark, sf_small):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = common.save(stage(spark, docs, sf_small), f"test-{name}")
        if k < 4:
            assert out.columns == list(pipeline.DOCUMENT_COLUMNS) and 0 < out.count() <= docs.count()
        docs = out
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def test_line_dedup_extends_into_partial_lines(spark):
    rng = random.Random(11)
    sentence = words(60, rng)  # one sentence, without an inner cut
    near = [words(9, rng).capitalize() + "! " for _ in range(8)]
    edited = ["Other " + near[0]] + near[1:-1] + [near[-1].rstrip() + "changed end."]
    docs = [(1, words(9, rng) + " " + sentence + " " + words(7, rng) + "."), (2, words(13, rng) + " " + sentence + " " + words(11, rng) + "."),
            (3, "".join(near)), (4, "".join(edited))]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[1].text == docs[0][1] and out[3].text == docs[2][1]
    assert out[2].text.split() == docs[1][1].split()[:13] + docs[1][1].split()[-11:]
    assert len(out[4].text.split()) <= 4


def test_line_dedup_short_lines_and_dense_scripts(spark):
    rng = random.Random(12)
    address = "\n".join(words(3, rng) for _ in range(20))
    dense = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(90))
    tabs = words(60, rng).replace(" ", "\t")
    docs = [(2 * k + n, ("first " if n else "second ") + t + "\n" + words(9, rng) + ".") for k, t in enumerate((address, dense, tabs), 1) for n in (0, 1)]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k, t in enumerate((address, dense, tabs), 1):
        assert out[2 * k].text == dict(docs)[2 * k]
        assert out[2 * k + 1].text.split() == dict(docs)[2 * k + 1].replace(t, "").split()


def test_line_dedup_finds_runs_whose_parts_have_other_origins(spark):
    rng = random.Random(13)
    a, b, c = (words(8, rng) + "." for _ in range(3))
    pool = [words(8, rng) + "." for _ in range(12)]
    docs = [(1, f"{a} {b}"), (5, f"{words(5, rng)}.\n{a} {b} {c}"), (9, f"{words(6, rng)}.\n{a} {b} {c}")]
    docs += [(20 + k, " ".join(rng.choice(pool) for _ in range(9))) for k in range(60)]  # pairs recur in many combinations
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: len(r.text.split()) for r in out if r.doc_id < 10} == {1: 16, 5: 29, 9: 6}
    seen, left = {}, 0
    for r in sorted(out):
        w = r.text.split()
        grams = {tuple(w[k:k + 51]) for k in range(len(w) - 50)}
        left += any(seen.get(g, r.doc_id) != r.doc_id for g in grams)
        seen.update((g, r.doc_id) for g in grams if g not in seen)
    assert left == 0


def test_fingerprints_of_long_texts_without_cuts(spark):
    rng = random.Random(14)
    dense = lambda: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(900))
    texts = [words(400, rng), words(400, rng), dense(), dense(), "\uffff " + words(400, rng), "! ".join(words(7, rng) for _ in range(60))]
    out = fingerprint.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(0.3 < r.near_edited < 0.9 and r.near_next < 0.1 for r in out)


def test_html_hidden_and_zone_words_of_wrappers():
    rng = random.Random(15)
    text = [words(40, rng).capitalize() + "." for _ in range(4)]
    body = "".join(f"<p>{t}</p>" for t in text)
    nav = '<nav><ul><li><a href="/">Home</a></li></ul></nav>'
    for attributes in ('class="content overflow-hidden"', 'class="content" style="overflow:hidden"', 'class="content has-sidebar"',
                       'class="content layout-sidebar-right"', 'class="content sidebar-right-layout"'):
        got = html_text.extract(f"<html><body>{nav}<div {attributes}>{body}</div></body></html>", html_text.PRIOR)
        assert got == "\n\n".join(text), attributes
    for attributes in ("hidden", 'class="hidden"', 'style="display: none"', 'style="visibility:hidden"', 'aria-hidden="true"', 'class="sidebar"'):
        page = f'<html><body><div class="content">{body}</div><div {attributes}><p>{words(30, rng)}.</p></div></body></html>'
        assert html_text.extract(page, html_text.PRIOR) == "\n\n".join(text), attributes
    assert "x + y" in html_text.extract(f"<article><p>{text[0]} <math><mi>x + y</mi></math> {text[1]}</p></article>", html_text.PRIOR)
