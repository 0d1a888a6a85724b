import random

import numpy as np
import pytest

from critiq.llm import fuzzy_lines as fl
from critiq.llm import simhash_dedup as sh
from critiq.llm import suffix_dedup as sd
from critiq.llm.components import components
from llm_texts import WORDS, prose


def roots(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(0)
    links = [(i, i + 1) for i in range(100, 160)]  # a long path
    links += [(1, rng.randint(200, 400)) for _ in range(80)]  # a hub
    links += [(rng.randint(500, 700), rng.randint(500, 700)) for _ in range(90)] + [(None, 3), (4, None), (9, 9), (100, 101)]
    got = components(spark, spark.createDataFrame(links, "x long, y long").repartition(5)).collect()
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert {r.node: r.component for r in got} == roots({n for p in real for n in p}, real)
    assert len(got) == len({r.node for r in got})
    assert components(spark, spark.createDataFrame([], "x long, y long")).count() == 0


def plain_fingerprint(text):
    import re

    import xxhash

    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_equal_a_plain_count():
    rng = random.Random(4)
    for text in [None, "", " \n", "A b", "ÀB c D e", "a b c d e f", *(prose(rng, rng.randint(1, 60)) for _ in range(60))]:
        assert sh.fingerprint(text and text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4, 7])
def test_links_join_all_fingerprints_within_the_distance(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    seeds = rng.integers(0, 2**63, 12, np.uint64)
    fps = set()
    for seed in seeds.tolist():  # clouds in which neighbours are a few bits apart, and chains
        for _ in range(25):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            fps.add(seed ^ sum(1 << int(b) for b in flips))
            seed ^= sum(1 << int(b) for b in rng.choice(64, max(max_bits, 1) if rng.random() < 0.3 else 0, replace=False))
    fps = np.array(sorted(fps), np.uint64)
    near = [
        (int(a), int(b)) for a in fps for b in fps if a < b and bin(int(a) ^ int(b)).count("1") <= max_bits
    ]
    frame = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    links = [(r.a % 2**64, r.b % 2**64) for r in sh.fingerprint_links(spark, frame, max_bits).collect()]
    assert all(bin(a ^ b).count("1") <= max_bits for a, b in links)
    nodes = {int(f) for f in fps}
    assert roots(nodes, links) == roots(nodes, near)
    assert len(links) < 6 * (max_bits + 1) * len(nodes)  # not all pairs


def test_simhash_components_equal_all_pairs(spark):
    rng = random.Random(5)
    docs = [(i, prose(rng, rng.randint(5, 200))) for i in range(60)]
    for i in range(60, 140):
        words = rng.choice(docs)[1].split()
        for _ in range(rng.choice([0, 1, 1, 3])):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        docs.append((i, " ".join(words)))
    docs += [(200, None), (201, ""), (202, "  ")]
    rng.shuffle(docs)
    fp = {i: plain_fingerprint(t) for i, t in docs}
    near = [(a, b) for a in fp for b in fp if a < b and bin(fp[a] ^ fp[b]).count("1") <= 4]
    got = sh.simhash_components(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.fp % 2**64 for r in got} == fp
    assert {r.doc_id: r.component_id for r in got} == roots(fp, near)


def test_simhash_on_odd_documents(spark, odd_documents):
    got = sh.simhash_components(spark, odd_documents).collect()
    assert len(got) == odd_documents.count()
    of = {r.doc_id: r.component_id for r in got}
    assert of[1] == of[5] == 1 and of[2] == of[3] == of[4] == of[None] == 2 or of[None] in (1, 2)
    first = sh.keep_first(spark, odd_documents)
    assert first.columns == odd_documents.columns
    ids = [r.doc_id for r in first.select("doc_id").collect()]
    assert None not in ids and sorted(ids) == sorted({c for c in of.values() if c is not None})
    assert sh.simhash_components(spark, odd_documents.limit(0)).count() == 0


def test_one_document_of_each_component_stays(spark):
    """Shared ids with different texts, copies without an id, and rows listed again."""
    rng = random.Random(31)
    a, b, c, d = (prose(rng, 80) for _ in range(4))
    docs = [(1, a), (1, b), (2, a), (None, b), (None, c), (None, c), (3, c), (4, d), (4, d), (None, prose(rng, 70)), (5, None), (6, ""), (7, b)]
    docs += [(20 + i, prose(rng, 60)) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS th", "'x' AS h", "2 AS n", "3 AS root")
    got = sh.keep_first(spark, frame)
    assert got.columns == frame.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    lone = docs[9]
    assert kept == sorted([(1, a), (1, b), (3, c), (4, d), lone, (5, None), *docs[13:]], key=repr)
    assert sh.keep_first(spark, frame.limit(0)).count() == 0


def test_documents_that_stay_are_not_shuffled(spark):
    rng = random.Random(32)
    frame = spark.createDataFrame([(i, prose(rng, 60)) for i in range(50)] + [(100, None)], "doc_id long, text string")
    plan = sh.keep_first(spark, frame)._jdf.queryExecution().optimizedPlan()
    first = plan.children().apply(0).toString()  # the branch of documents without a mark
    assert plan.nodeName() == "Union" and first.count("Join") == 1 and "broadcast" in first


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_line_dedup(docs):
    """Left texts by comparing all pairs of lines, by edit similarity alone (lines of ASCII characters)."""
    import duckdb

    places = {}
    for doc, text in docs:
        if doc is not None:
            for at, line, _ in fl.line_ids((text or "").encode(), 1):
                places.setdefault(line, set()).add((doc, at))
    lines = sorted(places)
    with duckdb.connect() as db:
        db.sql("create table lines (line varchar)")
        db.executemany("insert into lines values (?)", [[line] for line in lines])
        links = db.sql(
            f"select a.line, b.line from lines a join lines b on a.line < b.line and "
            f"levenshtein(a.line, b.line) <= floor(greatest(length(a.line), length(b.line)) * (1 - {fl.SIMILARITY}) + 1e-9)"
        ).fetchall()
    part = roots(lines, links)
    groups = {}
    for line in lines:
        groups.setdefault(part[line], set()).update(places[line])
    gone = {p for g in groups.values() for p in g - {min(g)}}
    return {
        doc: "\n".join(x for k, x in enumerate(text.split("\n")) if (doc, k) not in gone) for doc, text in docs if doc is not None and text is not None
    }, len(links)


@pytest.mark.parametrize("seed", [0, 1])
def test_fuzzy_lines_equal_all_pairs(spark, seed):
    """Lines with a changed word, with single characters changed all over the line, short ones, and many variants of one."""
    rng = random.Random(seed)

    def line(least, most):
        return prose(rng, rng.randint(least, most)).replace("é", "e")

    common = [line(5, 40) for _ in range(12)]
    docs = []
    for i in range(70):
        lines = [line(1, 30) for _ in range(rng.randint(0, 4))]
        for _ in range(rng.randint(0, 4)):
            words = rng.choice(common).split()
            change = rng.random()
            if change < 0.4:
                words[rng.randrange(len(words))] = rng.choice(WORDS).replace("é", "e")
            own = list(" ".join(words))
            if change > 0.7:  # three characters in a hundred
                for at in rng.sample(range(len(own)), max(1, len(own) * 3 // 100)):
                    own[at] = rng.choice("abcde")
            lines.append("".join(own).upper() if rng.random() < 0.2 else "".join(own))
        rng.shuffle(lines)
        docs.append((i, "\n".join(lines)))
    # many variants of one line: a bucket that is a cluster, not pairs
    base = line(45, 45).split()
    for i in range(100, 180):
        words = list(base)
        words[rng.randrange(len(words))] = rng.choice(WORDS).replace("é", "e")
        docs.append((i, " ".join(words)))
    docs += [(300, None), (301, ""), (None, docs[0][1])]
    want, n_links = plain_line_dedup(docs)
    assert n_links > 50
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in fl.dedup_lines(spark, frame).collect()}
    assert len(got) == len(docs)
    for doc, text in docs:
        if doc is None or text is None:
            assert got[doc].text == text and got[doc].n_removed == 0
        else:
            assert got[doc].text == want[doc], doc
            assert got[doc].n_lines == len(text.split("\n"))
            assert got[doc].n_removed == len(text.split("\n")) - len(want[doc].split("\n")) or not want[doc]


def test_fuzzy_lines_on_odd_documents(spark, odd_documents):
    got = fl.dedup_lines(spark, odd_documents)
    assert got.count() == odd_documents.count()
    left = fl.dedup_documents(spark, odd_documents)
    assert left.columns == odd_documents.columns
    kept = {r.doc_id for r in left.collect()}
    assert 5 not in kept and {-1, 1, 2, 3, 4, 6, 7, None} <= kept  # 5 repeats 1 line by line
    for r in left.where("doc_id = 8").collect():
        assert r.n_chars in (1, len(r.text))
    assert fl.dedup_lines(spark, odd_documents.limit(0)).count() == 0
    assert fl.dedup_documents(spark, odd_documents.limit(0)).count() == 0


def plain_substrings(docs, length):
    seen, out = {}, {}
    for doc, text in sorted({(d, (t or "").encode()) for d, t in docs if d is not None}):
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            if text[i : i + length] in seen:
                gone[i : i + length] = [True] * length
            seen.setdefault(text[i : i + length], (doc, i))
        spans = sum(x and not y for x, y in zip(gone, [False, *gone], strict=False))
        out[doc] = (len(text), sum(gone), spans, bytes(c for c, x in zip(text, gone, strict=True) if not x))
    return out


@pytest.mark.parametrize("sizes", [(1 << 24, 1 << 20), (2000, 600)])
def test_substrings_equal_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(sd, "CHUNK_BYTES", sizes[0])
    monkeypatch.setattr(sd, "SHARD_BYTES", sizes[1])
    rng = random.Random(sizes[1])
    passages = [prose(rng, rng.randint(18, 60)) for _ in range(6)] + ["ab" * 120, "z" * 300]
    docs = []
    for i in range(110):
        text = prose(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            if rng.random() < 0.5:
                k = rng.randrange(len(p))
                p = p[:k] + rng.choice(["X", ""]) + p[k + 1 :]
            text += " " + p + " " + prose(rng, rng.randint(0, 20))
        docs.append((i, text))
    docs += [(i, rng.choice(docs)[1]) for i in range(150, 180)]
    for i in range(190, 240):  # near copies of one text
        words = docs[3][1].split() or ["a"]
        words[rng.randrange(len(words))] = rng.choice(WORDS)
        docs.append((i, " ".join(words)))
    docs += [(300, None), (301, ""), (None, docs[0][1]), (5, docs[5][1])]
    rng.shuffle(docs)
    want = plain_substrings(docs, sd.LENGTH)
    docs_of_null = {len((t or "").encode()): t for d, t in docs if d is None}
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sd.dedup_substrings(spark, frame).collect()
    assert len(got) == len(docs)
    for r in got:
        if r.doc_id is None:
            own = plain_substrings([(0, docs_of_null[r.n_bytes])], sd.LENGTH)[0]
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == own
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id]


def test_suffix_array_and_common_prefixes():
    rng = random.Random(9)
    for t in range(120):
        data = bytes(rng.randint(97, 98 + t % 3) for _ in range(rng.randint(1, 200)))
        depth = rng.choice([8, 20, 100])
        order = sd.suffix_array(np.frombuffer(data, np.uint8), depth)
        parts = [data[i : i + depth] for i in order]
        assert parts == sorted(parts) and sorted(order) == list(range(len(data)))
        shared = sd.common_prefixes(np.frombuffer(data, np.uint8), order, depth)
        for i in range(1, len(order)):
            a, b = data[order[i - 1] :], data[order[i] :]
            m = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert min(shared[i], depth) == min(m, depth)


def substrings_of(spark, docs):
    got = sd.dedup_substrings(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(2)).collect()
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got)


def test_texts_that_share_an_id(spark):
    """Null and short texts beside a long one; a passage at different places of two texts of one document."""
    rng = random.Random(33)
    passage, x, y, z = (prose(rng, n)[: 256 if n == 60 else 90] for n in (60, 20, 20, 20))
    one, two = x + passage, y + z + passage
    parts = plain_substrings([(1, one), (2, passage)], sd.LENGTH)
    assert substrings_of(spark, [(1, one), (1, one), (2, passage)]) == sorted([(1, *parts[1])] * 2 + [(2, *parts[2])])
    for other in (None, "short"):
        empty = (0, 0, 0, b"") if other is None else (5, 0, 0, b"short")
        assert substrings_of(spark, [(1, one), (1, other), (2, y + passage)]) == sorted(
            [(1, *parts[1]), (1, *empty), (2, *plain_substrings([(1, one), (2, y + passage)], sd.LENGTH)[2])]
        )
    # one of the two keeps the passage, the other loses it, and nothing else goes
    got = substrings_of(spark, [(1, one), (1, two), (3, x + z)])
    either = []
    for first, second in ((one, two), (two, one)):
        want = plain_substrings([(1, first), (1.5, second), (3, x + z)], sd.LENGTH)
        either.append(sorted([(1, *want[1]), (1, *want[1.5]), (3, *want[3])]))
    assert got in either and either[0] != either[1]
    # 100 and more texts of one document
    many = [(1, prose(rng, 5) + passage + prose(rng, 5)) for _ in range(100)]
    got = substrings_of(spark, many)
    assert sum(r[2] == 0 for r in got) == 1 and all(r[2] >= 256 for r in got if r[2])


def test_a_document_without_an_id_is_compared_with_itself(spark):
    rng = random.Random(34)
    passage = prose(rng, 60).replace("é", "e")[:256]
    docs = [(None, passage + "x" + passage), (None, passage), (1, passage)]
    got = {r[1]: r[2] for r in [(*r,) for r in map(lambda r: (r.doc_id, r.n_bytes, r.n_removed), sd.dedup_substrings(
        spark, spark.createDataFrame(docs, "doc_id long, text string")).collect())]}
    assert got == {513: 256, 256: 0}


def test_substrings_on_odd_documents(spark, odd_documents):
    got = sd.dedup_substrings(spark, odd_documents).collect()
    assert len(got) == odd_documents.count()
    by = {r.doc_id: r for r in got}
    assert by[5].n_removed == by[5].n_bytes and by[1].n_removed == 0 and by[7].n_removed == 49_999
    assert by[None].n_removed == 0 and by[2].n_bytes == 0
    assert sd.dedup_substrings(spark, odd_documents.limit(0)).count() == 0
