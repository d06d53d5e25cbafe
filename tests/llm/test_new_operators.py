"""Spelling variants, importance resampling and source mixing against brute force, with edge cases."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starwash.llm import decontaminate, html_text, line_dedup, mixing, near_dedup, queries, resample, spelling, url_filter
from starwash.llm.common import rows_with_ids
from starwash.llm.positions import with_position

EDGE = [(1, None, "a"), (2, "", "a"), (3, " \n ", None), (None, "no ident here", None), (4, "letters letters letters", "b"),
        (4, "letters letters letters", "b"), (5, "lettres lettres lettres", "B"), (6, "letter " * 30_000, "b"), (7, "Über 😀 naïve", "é")]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, s, "x", 1, 2) for i, t, s in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, word string, n int, size int")


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    near = {w: [x for x in counts if x != w and is_near(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def collected(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


@pytest.mark.parametrize("cell_words", [15, 10_000])
def test_variants_equal_all_pairs(spark, cell_words):
    rng = random.Random(cell_words)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(5, 8))) for _ in range(500)}
    words |= {"".join(p) for p in itertools.permutations("abcdef")}  # one multiset of letters on many words
    words |= {"".join(p) for p in itertools.islice(itertools.permutations("abcdeg"), 300)}
    words |= {"x" * 5, "x" * 6, "x" * 400, "x" * 401, "ÀÉÿ÷×"}
    counts = {w: rng.choice([3, 5, 9, 20, 41, 90]) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert collected(spelling.variants(frame, cell_words=cell_words)) == brute_variants(counts)


def test_groups_of_anagrams_meet_without_pairs():
    rng = random.Random(3)
    for x, y in ((["".join(p) for p in itertools.permutations("aabcd")], ["".join(p) for p in itertools.permutations("abbcd")]),
                 (["".join(p) for p in itertools.permutations("aabc")], ["".join(p) for p in itertools.permutations("aabbc")])):
        x, y = sorted(set(x)), sorted(set(y))
        rng.shuffle(y)
        want = sorted((i, j) for i, a in enumerate(x) for j, b in enumerate(y) if is_near(a, b))
        for limit in (0, 1 << 16):
            got = sorted((int(i), int(j)) for a, b in spelling.near_pairs(x, y, limit) for i, j in zip(a, b))
            assert got == want


def test_spelling_of_documents(spark, edge):
    def brute(rows):
        counts = Counter()
        for doc, text in rows:
            for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
                h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
                if h % 5 == 0:
                    w = w[: h % len(w)] + w[h % len(w) + 1 :]
                counts[w] += 1
        return brute_variants({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})

    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefÉé") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = [(k, " ".join(rng.choices(vocabulary, k=60)) + "!") for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(spelling.spelling_variants(docs, typo_every=5)) == brute(rows)
    assert collected(spelling.spelling_variants(edge, typo_every=5)) == brute([(i, t) for i, t, _ in EDGE])
    assert spelling.spelling_variants(edge.limit(0)).count() == 0


def test_chains_of_forms_lead_to_their_end(spark):
    links = [(f"w{k}", f"w{k + 1}") for k in range(37)] + [("a", "w5"), ("b", "w36")]
    got = {r.word: r.root for r in spelling.roots_of(spark.createDataFrame(links, "word string, form string")).collect()}
    assert len(got) == 39 and set(got.values()) == {"w37"}


def test_positions(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 50) or None, k) for k in range(3000)]
    got = with_position(spark.createDataFrame(rows, "a int, b int"), [F.col("a").desc_nulls_last(), F.col("b")]).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(1, 3001))


def features(text, n):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return words, [b" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def test_head_and_tail_give_the_same_buckets():
    words, runs = features("The cat sat on the mat, the cat 7 été " * 3, 4)
    for n in (1, 2, 3, 4):
        want = Counter(zlib.crc32(f) % 97 for f in runs if f.count(b" ") < n)
        for states, pairs in (({}, {}), ({b"the": zlib.crc32(b"the")}, {(b"the", b"cat"): zlib.crc32(b"the cat") % 97})):
            assert Counter(resample.feature_buckets(words, n, 97, resample._States(states), pairs).tolist()) == want
    assert not len(resample.feature_buckets([], 3, 97, resample._States(), {}))


@pytest.mark.parametrize("max_n", [1, 2])
def test_resample_equals_brute_force(spark, edge, max_n):
    rng = random.Random(max_n)
    vocabulary = ["w%d" % int(rng.paretovariate(0.7)) for _ in range(2000)]
    rows = [(100 + k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for k in range(400)] + [(i, t) for i, t, _ in EDGE if i not in (None, 4)]
    goal = [(k, " ".join(rng.choices(vocabulary[:100], k=30))) for k in range(20)] + [(21, None)]
    docs, target = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(goal, "item_id long, text string")
    s, t = Counter(), Counter()
    for table, count in ((rows, s), (goal, t)):
        for _, text in table:
            count.update(zlib.crc32(f) % 50 for f in features(text, max_n)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 50) / ((s[b] + 1) * (t.total() + 50)))) for b in range(50)]
    want, eligible = {}, []
    for k, (i, text) in enumerate(rows):
        words, found = features(text, max_n)
        weight = sum(gain[zlib.crc32(f) % 50] for f in found)
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want[i] = [len(found), weight, score, None]
        if len(words) >= 20:
            eligible.append((-score, i))
    for rank, (_, i) in enumerate(sorted(eligible)[: 10 * len(eligible) // 100], 1):
        want[i][3] = rank
    out = resample.resample(docs, target, max_n=max_n, buckets=50)
    assert {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in out.collect()} == want
    assert resample.drawn(docs, out).count() == 10 * len(eligible) // 100
    assert resample.resample(edge, target, buckets=50).count() == len(EDGE)
    assert resample.resample(edge.limit(0), target.limit(0)).count() == 0


def brute_targets(sizes, weights):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        goal = {s: 3.0 * sizes[s] if s in capped else w[s] * rest / sum(w[x] for x in free) for s in names}
        above = {s for s in free if goal[s] > 3 * sizes[s]}
        if not above:
            return goal
        capped |= above


def test_mixing_meets_targets(spark, edge):
    rng = random.Random(9)
    rows = []
    for k in range(3000):  # a third of all rows in one source
        source = rng.choice(["hot", "hot", "s1", "s2", "s3", "é", None])
        rows.append((k, " ".join(["w"] * min(4000, int(10 * rng.paretovariate(0.8)))) if rng.random() > 0.05 else None, source))
    rows += [(5000 + k, "few words", "tiny") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix(docs, (5, 2, 1))
    out = plan.collect()
    sizes, taken, largest = Counter(), Counter(), defaultdict(int)
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.copies <= 3
    goal = brute_targets(sizes, (5, 2, 1))
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source], rel=1e-12)
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in sizes)
    assert max(goal[s] / sizes[s] for s in sizes) == 3 and sum(goal.values()) == pytest.approx(sum(sizes.values()))
    again = mixing.mix(docs.repartition(5), (5, 2, 1)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    emitted = mixing.emit(docs, plan)
    assert emitted.count() == sum(r.copies for r in out)


def test_mixing_edge_cases(spark, edge):
    out = mixing.mix(edge, (5, 2, 1)).collect()
    assert len(out) == len(EDGE) and all(r.copies * r.size == 0 for r in out if not r.size)
    assert {r.source for r in out} == {"a", "b", "B", "é", None} and {r.target for r in out if r.source == "a"} == {0.0}
    assert mixing.mix(edge.limit(0), (1,)).count() == 0
    assert {r.copies for r in mixing.mix(edge.filter("doc_id < 3"), (1,)).collect()} == {0}


def prose(n, rng):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n)]


@pytest.mark.parametrize("length", [20, 25, 30, 60])
def test_every_pasted_passage_is_found(spark, length):
    rng = random.Random(length)
    docs, where = [], {}
    for k in range(200):  # pasted into the middle of a sentence of two texts
        passage = prose(length, rng)
        for i in (2 * k, 2 * k + 1):
            before, after = prose(rng.randint(1, 40), rng), prose(rng.randint(1, 40), rng)
            docs.append((i, " ".join(before + passage + after)))
            where[i] = before + after
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(out[i].text == t for i, t in docs if i % 2 == 0)
    assert [i for i, _ in docs if i % 2 and out[i].text.split() != where[i]] == []


def test_line_dedup_of_real_texts(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    earlier20, earlier51, left = set(), set(), 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        words, kept = r.text.split(), out[r.doc_id].split()
        own = set()  # words that stand earlier, in this text or another one, in a run of 20
        seen = {}
        for k in range(len(words) - 19):
            gram = tuple(words[k : k + 20])
            if gram in earlier20 or gram in seen:
                own.update(range(k, k + 20))
            seen.setdefault(gram, k)
        at = 0  # what is kept is in order, and only words of such runs are gone
        for k, w in enumerate(words):
            if at < len(kept) and kept[at] == w:
                at += 1
            else:
                assert k in own or any(j in own for j in range(k - 20, k + 20)), (r.doc_id, k)
        assert at == len(kept)
        left += any(tuple(kept[k : k + 51]) in earlier51 for k in range(len(kept) - 50))
        earlier20.update(seen)
        earlier51.update(tuple(words[k : k + 51]) for k in range(len(words) - 50))
    assert left == 0


def test_line_dedup_keeps_columns_of_any_name(spark):
    rng = random.Random(4)
    text = " ".join(prose(30, rng))
    rows = [(1, text, 0, "x", 3), (2, text + " end", 1, "y", 4)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, d int, v string, runs int")).collect()
    assert [(r.text, r.d, r.v, r.runs) for r in sorted(out)] == [(text, 0, "x", 3), ("end", 1, "y", 4)]


def test_input_columns_may_have_any_name(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "b", 2, 3)], "page_id long, url string, best string, n int, _url int")
    out = url_filter.judge(pages, url_filter.rule_table(spark, queries.URL_RULES)).collect()
    assert [(r.best, r.n, r["_url"], r.rule, r.verdict) for r in out] == [("b", 2, 3, "org/", "allow")]
    text = " ".join(f"word{k}" for k in range(12))
    docs = spark.createDataFrame([(1, text, "k", 5, 6), (2, None, "k", 5, 6)], "doc_id long, text string, k1 string, k2 int, hits int")
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    out = sorted(decontaminate.mark(docs, items).collect())
    assert [(r.k1, r.k2, r.hits, r.n_hit) for r in out] == [("k", 5, 6, 12), ("k", 5, 6, 0)]


def test_pipeline_stages_keep_any_columns(spark, sf_small):
    import corpus_pipeline as pipeline

    rows = [(1, None, "a", 1, 2, 9), (2, "", "b", 1, 2, 9), (3, "Some words of a short text.", "c", 1, 2, 9), (None, "no id", "d", 1, 2, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, k1 int, n_removed int, score int")
    for name, stage in pipeline.STAGES[:4]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, docs.collect())), name
        assert stage(spark, docs.limit(0), sf_small).count() == 0, name


def test_html_tags_as_browsers_read_them():
    rng = random.Random(21)
    text = [" ".join(prose(40, rng)).capitalize() + "." for _ in range(3)]
    for odd in ("<p data-x=it's>{}</p>", '<p>{} <img alt="the 5" screen"></p>', '<p title=a"b>{}</p>', "<p class = 'x' hidden-x>{}</p>",
                "<p>{}<br/></p>", "<p>{}</p><script src=/js/>var x = '<p>code</p>';</script>", "<p>{}</p><style media=a/>p {{}}</style>",
                "<p>{}</p><span data-a=/b/></span>"):
        page = "<html><body><article>" + "".join(odd.format(t) for t in text) + "</article></body></html>"
        assert html_text.extract(page, html_text.PRIOR) == "\n\n".join(text), odd
    for deep in ('<div class="content main">', '<span id=a>', "<b>"):
        page = "<html><body>" + deep * 20_000 + f"<p>{text[0]}</p>" + "</i>" * 20_000
        began = time.time()
        html_text.blocks_of(page)
        assert time.time() - began < 3


def test_rows_with_ids_is_a_semi_join(spark):
    rows = spark.range(20_000).select("id", (F.col("id") * 3).alias("x")).union(spark.sql("select null, 1L"))
    ids = spark.range(0, 40_000, 7).unionByName(spark.range(0, 100))
    for bits in (1 << 29, 1):
        got = rows_with_ids(rows, ids, "id", bits)
        assert got.columns == ["id", "x"] and sorted(r.id for r in got.collect()) == sorted({*range(0, 20_000, 7), *range(100)})
    assert rows_with_ids(rows, ids.limit(0), "id").count() == 0


def test_rows_with_ids_meet_the_bitmap_first(spark, tmp_path):
    """The optimizer must not move the join with the ids below the bitmap, where all rows are shuffled."""
    spark.range(5_000).select("id", F.col("id").cast("string").alias("t")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    plan = rows_with_ids(rows, rows.filter("id % 50 = 0").select("id"), "id")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 2 and "getbit" in joins[1] and "getbit" not in joins[0]


def test_copies_edited_to_just_below_the_threshold(spark):
    """Every copy is near the threshold to all others, so sketches rule out none: components equal all pairs."""
    rng = random.Random(30)
    base = prose(150, rng)
    docs = []
    for k in range(120):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(0, 7)):
            words[at] = f"edit{k}x{at}"
        docs.append((k, " ".join(words)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for _, t in docs]
    root = list(range(120))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(120), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (292 - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    out = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in out.collect()} == {k: find(k) for k in range(120)}
