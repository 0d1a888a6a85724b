import math
import os
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from critiq.llm import ann, mixing, queries, toxicity, url_filter, warc_index
from llm_texts import prose

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    with duckdb.connect() as db:
        for file in os.listdir(SF):
            db.sql(f"create view {file.split('.')[0]} as select * from read_parquet('{SF}/{file}')")
        want = db.sql(queries.oracle_sql()[name])
        columns, want = want.columns, want.fetchall()
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == Counter(want)


PAGES = [
    (1, "http://a.example.org/es/x", "<p>one</p>"), (2, "HTTPS://B.ORG/", "<p>one</p>"), (3, "http://org/es/", "<p>two</p>"),
    (4, "http://www.example.org/en/12?q=://x", ""), (5, None, None), (6, "no scheme here", "<p>one</p>"), (7, "", "ü"),
    (8, "http://notexample.org", "<p>one</p>"), (9, "http://x.com/de/1#f", "<p>two</p>"), (None, "http://x.com/fr/", "<p>one</p>"),
    (10, "http://x.com/de/1#f", "<p>two</p>"), (10, "http://x.com/de/1#f", "<p>two</p>"), (11, "http://cheap-pills.net/", "é" * 40_000),
    (0, "http://x.net/a.EXE?x", "late"), (12, "http://y.net/wp-admin/\n", "late"), (13, "http://y.net/ü 1", ""),
]


@pytest.fixture()
def pages(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    return frame.selectExpr("*", "1 as size", "'x' as digest", "null as holder", "2 as key", "3 as verdict", "4 as token", "5 as path")


def plain_verdict(url):
    import re

    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in url_filter.SITE_RULES:
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start):
            fits.append((len(rule), rule, verdict))
    hits = [v for v, pattern, _ in url_filter.PATTERN_RULES if url is not None and re.search(pattern, url)]
    other = "block" if "block" in hits and "allow" not in hits else "allow"
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else other, len(hits)


def test_url_filter_equals_a_scan_of_all_rules(spark, pages):
    got = url_filter.filter_urls(spark, pages).collect()
    want = Counter((i, *plain_verdict(u)) for i, u, _ in PAGES)
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict, r.pattern_hits) for r in got) == want
    shuffled = url_filter.filter_urls(spark, pages, broadcast_rules=0).collect()
    assert Counter(tuple(r) for r in shuffled) == Counter(tuple(r) for r in got)
    assert url_filter.filter_urls(spark, pages.limit(0)).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("http://example.org/a",), ("http://x.org/",), ("http://y.org/",)], "url string")
    rules = [url_filter.site_rule("block", "example.org/a"), url_filter.Rule("block", "x", ())]
    rows = {r.rule_id: r.token for r in url_filter.rule_index(spark, urls, rules).collect()}
    assert rows == {0: "example", 1: ""}


def test_url_filter_plan_has_no_python(spark, pages):
    plan = url_filter.filter_urls(spark, pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_warc_round_trip(spark, pages):
    import base64
    import hashlib

    holders = defaultdict(list)
    for i, _, html in PAGES:
        holders[(html or "").encode()].append(i)
    want = Counter()
    for i, url, html in PAGES:
        payload = (html or "").encode()
        first = min((p for p in holders[payload] if p is not None), default=None)
        revisit = first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want[i, url, len(payload), digest, "revisit" if revisit else "response", first if revisit else None] += 1
    got = warc_index.archive_round_trip(spark, pages, block_lines=2).collect()
    assert Counter((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert warc_index.archive_round_trip(spark, pages.limit(0)).count() == 0


def test_lookup_by_key_and_small_payloads(spark, pages):
    archive = warc_index.write_archive(spark, pages, min_bytes=100, block_lines=1)
    keys = spark.createDataFrame([("com,x)/de/1",), ("com,absent)/",), (None,)], "key string")
    found = warc_index.find(spark, archive, keys).collect()
    assert sorted(r.page_id for r in found) == [9, 10, 10]
    assert {bytes(r.payload) for r in found} == {b"<p>two</p>"}
    again = warc_index.open_archive(spark, archive.root)
    assert again == archive
    every = warc_index.find(spark, archive, warc_index.url_keys(pages))
    assert every.count() == len(PAGES) and every.where("record_type = 'revisit'").count() == 0


def test_directory_search_finds_every_block_that_can_hold_a_key():
    class File:
        def __init__(self, data):
            self.data = data

        def read_at(self, n, at):
            return self.data[at : at + n]

    rng = random.Random(1)
    for _ in range(200):
        firsts = sorted(rng.choice("abcd") * rng.randint(0, 6) for _ in range(rng.randint(1, 30)))
        data = "".join(f"{k}\t{i}\t1\n" for i, k in enumerate(firsts)).encode()
        for key in {*firsts, "", "a", "bb", "zz"}:
            before = [i for i, k in enumerate(firsts) if k < key]
            want = before[-1:] + [i for i, k in enumerate(firsts) if k == key]
            got = [i for i, _ in warc_index.directory_entries(File(data), len(data), key.encode())]
            assert got == want, (firsts, key)


@pytest.mark.parametrize("weights", [(3, 1, 2), (1, 50)])
def test_targets_equal_resharing_step_by_step(spark, weights):
    rng = random.Random(3)
    sizes = {None: 70, **{f"s{i}": rng.choice([0, 5, 40, 1000]) for i in range(9)}}
    order = sorted(k for k in sizes if k is not None) + [None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        share = left / sum(weight[s] for s in free)
        above = {s for s in free if share * weight[s] > 2 * sizes[s]}
        if not above:
            target.update({s: share * weight[s] for s in free})
            break
        target.update({s: 2.0 * sizes[s] for s in above})
        left -= sum(2 * sizes[s] for s in above)
        free -= above
    rows = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r.source: (r.source_size, r.target) for r in mixing.source_targets(rows, weights).collect()}
    for s in order:
        assert got[s][0] == sizes[s] and math.isclose(got[s][1], target[s], abs_tol=1e-6)


def test_mix_is_near_its_targets_and_nested(spark):
    rng = random.Random(5)
    docs = [(i, prose(rng, rng.randint(0, 40)), rng.choice(["a", "b", "c", None, "d"])) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    got = mixing.mix(spark, frame).collect()
    again = mixing.mix(spark, frame.repartition(2)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and len(got) == len(docs)
    for s in ("a", "b", "c", None, "d"):
        own = [r for r in got if r.source == s]
        largest = max(r.size for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= largest / 2
        assert sum(r.size for r in own) == own[0].source_size
        assert max(r.copies for r in own) <= 2
    smaller = {r.doc_id: r.copies for r in mixing.mix(spark, frame, budget=1.2, weights=(1,)).collect()}
    larger = {r.doc_id: r.copies for r in mixing.mix(spark, frame, budget=1.4, weights=(1,)).collect()}
    assert all(smaller[i] <= larger[i] for i in smaller)


def test_mix_on_odd_documents(spark, odd_documents):
    got = mixing.mix(spark, odd_documents).collect()
    assert len(got) == odd_documents.count()
    assert all(r.taken <= 2 * r.size for r in got)
    taken = mixing.mixed_documents(spark, odd_documents)
    assert taken.columns == odd_documents.columns
    assert taken.count() == sum(r.copies for r in got if r.size)  # without words there is nothing to take
    assert mixing.mix(spark, odd_documents.limit(0)).count() == 0
    assert mixing.mixed_documents(spark, odd_documents.limit(0)).count() == 0


def brute_nearest(rows, every, k):
    out = {}
    for i, v in rows.items():
        if i % every == 0:
            ids = np.array([j for j in rows if j != i])
            score = (np.array([rows[j] for j in ids]) * v).sum(axis=1) if len(ids) else np.empty(0)
            best = np.lexsort((ids, -score))[:k]
            out[i] = list(zip(ids[best].tolist(), score[best].tolist(), strict=True))
    return out


def as_lists(found):
    out = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def test_ann_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE_PER_LIST", 8)
    monkeypatch.setattr(ann, "CHUNK_ROWS", 300)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 40)
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((12, 24)) * 2
    table = centers[rng.integers(0, 12, 1800)] + rng.standard_normal((1800, 24))
    table *= rng.uniform(0.5, 2, (1800, 1))  # the largest product is not the nearest direction
    table[900:1100] = table[900]  # one very common vector
    rows = {i: v for i, v in enumerate(table)}
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "vec_id long, embedding array<double>").repartition(4)
    got, want = as_lists(ann.nearest(spark, frame).collect()), brute_nearest(rows, 20, 20)
    assert set(got) == set(want)
    found = 0
    for i, best in want.items():
        assert len(got[i]) == 20
        assert got[i] == sorted(got[i], key=lambda p: (-p[1], p[0]))
        exact = {j: float((rows[j] * rows[i]).sum()) for j, _ in got[i]}
        assert all(math.isclose(exact[j], s, rel_tol=1e-12, abs_tol=1e-12) for j, s in got[i])
        found += len({j for j, _ in got[i]} & {j for j, _ in best})
    assert found >= 0.95 * 20 * len(want)


def test_ann_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [0.0, 0.0]), (7, [None, 1.0]),
        (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [2.0, 1.0]), (20, [2.0, 1.0]), (40, None), (60, []), (9, [1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as list", "2 as chunk", "3 as score")
    got = as_lists(ann.nearest(spark, frame).collect())
    assert got == {0: [(20, 2.0), (1, 1.0), (9, 1.0), (2, 0.0)], 20: [(0, 2.0), (1, 2.0), (9, 2.0), (2, 1.0)]}
    assert ann.nearest(spark, frame.limit(0)).count() == 0
    assert ann.nearest(spark, frame.where("vec_id = 0")).count() == 0


def test_scan_abandons_most_candidates():
    rng = np.random.default_rng(0)
    points = rng.standard_normal((4000, 64)).astype(np.float32)
    query = points[0] + 0.1 * rng.standard_normal(64).astype(np.float32)
    exact = ((points - query) ** 2).sum(axis=1)
    blocks = [points[:, c : c + 16] for c in range(0, 64, 16)]
    far = rng.standard_normal(64).astype(np.float32)
    queries, limits = np.stack([query, far, far]), np.array([np.sort(exact)[40], np.inf, 0.0])
    alive = np.ones((3, 4000), bool)
    alive[1, ::2] = False
    left = ann.scan(queries, blocks, alive, limits, 2.1)
    assert set(np.argsort(exact)[:10]) <= set(np.flatnonzero(left[0])) and left[0].sum() < 60
    assert np.array_equal(left[1], alive[1]) and not left[2].any()


def toxic_table(rng, n):
    rows, labels = [], []
    for i in range(n):
        words, toxic = prose(rng, rng.randint(10, 120)).split(), rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(["grunzfug", "Blorkish", "zweemp"]) + rng.choice(["", "er", "ly"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_held_out_accuracy_and_reruns(spark):
    rows, labels = toxic_table(random.Random(8), 700)
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(spark, documents, known).collect()}
    truth = {i: t for i, _, t in labels}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [i for i, r in got.items() if r.held_out]
    assert sum(got[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    # labels of the held-out fold are never looked at, and reruns agree
    flipped = spark.createDataFrame([(i, 1, 1 - t if got[i].held_out else t) for i, _, t in labels], "doc_id long, quality int, toxic int")
    again = {r.doc_id: r.score for r in toxicity.classify(spark, documents.repartition(5), flipped).collect()}
    assert all(math.isclose(again[i], r.score, rel_tol=1e-9) for i, r in got.items())


def test_toxicity_defined_cases(spark, odd_documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.classify(spark, odd_documents, none).collect()
    assert len(scored) == odd_documents.count() and all(r.predicted == 0 for r in scored)
    assert not next(r for r in scored if r.doc_id is None).held_out
    rows, labels = toxic_table(random.Random(1), 200)
    model = toxicity.train(
        spark, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), per_class=40
    )
    empty = model.scores([None, b"", b"ab"])
    assert empty[0] == empty[1] == empty[2]
    assert toxicity.score(odd_documents.limit(0), model).count() == 0
    # blocks do not change a text's features
    text = (" ".join(r[1] for r in rows)).encode()
    whole = toxicity.text_features(text)
    toxicity.BLOCK_CHARS, kept = 1000, toxicity.BLOCK_CHARS
    assert np.array_equal(whole, toxicity.text_features(text))
    toxicity.BLOCK_CHARS = kept


def test_pipeline_stages_work_on_what_came_before(spark):
    import corpus_pipeline

    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        kept = spark.createDataFrame(after.collect(), docs.schema)
        assert kept.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert pieces.where("piece = 0").count() == kept.count()
    assert corpus_pipeline.run(spark, SF).where("piece = 0").count() == kept.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_one_row_of_a_labelled_id_trains(spark):
    """Rows that share a labelled id: the sample has as many rows as ids, whatever their number."""
    docs = [(i % 2, f"text {i}") for i in range(3000)] + [(2, "other")]
    documents = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(3)], "doc_id long, quality int, toxic int")
    sample = toxicity.training_sample(documents, labels, 10)
    held = {i for i in range(3) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sample.count() == len({0, 1, 2} - held)


def test_texts_without_words_are_never_mixed_in(spark):
    docs = [(i, None if i % 3 == 0 else " \n" if i % 3 == 1 else "a b c", "s") for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    mixed = mixing.mixed_documents(spark, frame)
    assert mixed.columns == frame.columns
    assert {r.text for r in mixed.select("text").distinct().collect()} == {"a b c"}
