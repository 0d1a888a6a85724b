import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from critiq.llm import attention_lm, lexical_search, spelling
from llm_texts import prose

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string"


# -- ranked search ------------------------------------------------------------
def brute_search(docs, items, k):
    held = [(d, [t.translate(UPPER) for t in TERM.findall(text or "")]) for d, text in docs]
    held = [(d, Counter(t), len(t)) for d, t in held if t]
    n_all, l_all = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    texts = defaultdict(list)
    for i, text in items:
        if i is not None and text is not None:
            texts[i].append(text.encode())
    out = {}
    for i, found in texts.items():
        asked = Counter(t.translate(UPPER) for t in TERM.findall(min(found).decode()))
        rows = []
        for d, c, n in held:
            m = 25 + (75 * n * n_all) // l_all
            s = 0
            for t, times in asked.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                    s += times * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                rows.append((-s, d is None, d or 0))
        if rows:
            out[i] = [(None if none else d, -s) for s, none, d in sorted(rows)[:k]]
    return out


def ranked(frame):
    out = defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r["item_id"], r["rank"])):
        out[r["item_id"]].append((r["doc_id"], r["score"]))
        assert r["rank"] == len(out[r["item_id"]])
    return dict(out)


@pytest.mark.parametrize("shard, block, short, k", [(4096, 512, 0.125, 10), (40, 8, 0.5, 3), (7, 3, 0.0, 5), (5, 5, 1.0, 2)])
def test_search_equals_scoring_everything(spark, monkeypatch, shard, block, short, k):
    for name, value in (("SHARD_DOCS", shard), ("BLOCK_DOCS", block), ("SHORT_SHARE", short)):
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(shard)
    docs = [(i % 90, prose(rng, rng.choice([1, 5, 30, 300]))) for i in range(120)]
    docs += [(None, prose(rng, 20)), (None, None), (200, ""), (201, "!?"), (202, "KAne'É x"), (203, docs[3][1]), (204, docs[3][1]), *docs[:3]]
    items = [(i, prose(rng, rng.choice([1, 3, 40]))) for i in range(12)]
    items += [(3, "a smaller text kane"), (None, "kane"), (50, None), (51, ""), (52, "nowhere"), (53, "KANE kané ÉÉ é"), (54, docs[5][1])]
    want = brute_search(docs, items, k)
    documents = spark.createDataFrame(docs, DOCS).repartition(3).selectExpr("*", "1 AS item_id", "'x' AS shard", "2 AS score")
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' AS doc_id", "3 AS rank")
    assert ranked(lexical_search.search(spark, documents, benchmark, k)) == want


def test_search_of_odd_and_empty_tables(spark, odd_documents):
    items = [(1, prose(random.Random(7), 80)), (2, "世界 é"), (3, "x" * 50_000)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert ranked(lexical_search.search(spark, odd_documents, benchmark)) == brute_search(docs, items, 10)
    for some, asked in ((odd_documents.limit(0), benchmark), (odd_documents, benchmark.limit(0))):
        found = lexical_search.search(spark, some, asked)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 4)
    rng = random.Random(3)
    docs = [(i, prose(rng, 30)) for i in range(40)]
    items = [(i, prose(rng, 6)) for i in range(11)]
    found = lexical_search.search(spark, spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    assert ranked(found) == brute_search(docs, items, 10)


# -- spelling variants --------------------------------------------------------
def brute_variants(docs):
    counts = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, form.get(w), root(w), len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def variants_of(frame):
    rows = [(r["word"], r["n"], r["form"], r["root"], r["n_near"], r["form_n"]) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("block, split", [(1024, 1 << 15), (8, 5), (3, 1)])
def test_variants_equal_all_pairs(spark, monkeypatch, block, split):
    """Words of few letters, so that many are near each other, some by repeated letters; chains of forms."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "SPLIT_WORDS", split)
    rng = random.Random(block)
    words = ["".join(rng.choice("abÉé") for _ in range(rng.choice([6, 7, 7, 8, 9]))) for _ in range(250)]
    words += ["commonword"] * 900 + ["commonwordd"] * 80 + ["commonworddd"] * 6 + ["commonworde"] * 80 + ["cmmonword"] * 7
    words += [w[:3] + w[4:] for w in words[:40]] + [w + "b" for w in words[:40]] + words[:60]
    rng.shuffle(words)
    docs = [(i, " ".join(words[i::37]) + rng.choice(["", ".", " 世 x1y"])) for i in range(37)]
    docs += [(None, "Commonword commonword"), (None, None), (3, ""), (3, "commonwords commonwords"), (40, "aaaaaaaaaa aaaaaaaaa aaaaaaaaaaa " * 3)]
    frame = spark.createDataFrame(docs, DOCS).repartition(3).selectExpr("*", "1 AS n", "'x' AS word", "2 AS half", "3 AS part")
    got = variants_of(spelling.variants(spark, frame))
    assert got == brute_variants(docs)
    forms = {w: f for w, _, f, *_ in got}
    assert forms["commonwordd"] == "commonword" and forms["commonworddd"] in ("commonwordd", "commonword")


def test_variants_of_odd_and_empty_tables(spark, odd_documents):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    docs.append((77, ("y" * 3000 + " ") * 2 + ("y" * 3001 + " ") * 25))
    frame = odd_documents.select("doc_id", "text").union(spark.createDataFrame(docs[-1:], DOCS))
    assert variants_of(spelling.variants(spark, frame)) == brute_variants(docs)
    assert spelling.variants(spark, odd_documents.limit(0)).collect() == []


# -- attention model ------------------------------------------------------------
def some_classes():
    counts = (1e5 / (1 + np.arange(attention_lm.N_IDS))).astype(np.int64)
    return attention_lm.Classes.fit(counts, counts // 2, np.arange(attention_lm.N_IDS) % 3)


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    weights = attention_lm.Attention.start(some_classes().prior)
    x, target = rng.integers(0, 50, (3, 7)), rng.integers(0, attention_lm.CLASSES, (3, 7))
    mask = np.ones((3, 7), np.float32)
    mask[1, 4:] = 0

    def loss(w):
        return -(attention_lm.Attention(w).log_classes(x, target).astype(float) * mask).sum() / mask.sum()

    g, at = attention_lm.Attention(weights).gradient(x, target, mask), 0
    for shape in attention_lm.Attention.SHAPES.values():  # the steepest weight of each kind
        n = int(np.prod(shape))
        i = at + int(np.argmax(np.abs(g[at : at + n])))
        step = np.zeros_like(weights)
        step[i] = 1e-2
        assert (loss(weights + step) - loss(weights - step)) / 2e-2 == pytest.approx(g[i], rel=0.05, abs=2e-4)
        at += n


def test_every_id_is_scored_once_from_what_is_before_it():
    classes, rng = some_classes(), np.random.default_rng(2)
    model = attention_lm.Attention(attention_lm.Attention.start(classes.prior))
    sizes = np.array([1, 5, 64, 65, 112, 113, 300, 0, 2])
    flat = rng.integers(0, 3000, sizes.sum()).astype("<u2")
    starts = np.cumsum(sizes) - sizes
    got = attention_lm.scored(model, classes, flat, starts, starts + sizes)
    step = attention_lm.WINDOW - attention_lm.OVERLAP
    for s, n in zip(starts, sizes, strict=True):
        ids = flat[s : s + n].astype(int)
        for t in range(n):
            # the first window that has the id: windows begin every ``step`` ids
            window = 0 if t < attention_lm.WINDOW else -(-(t - attention_lm.WINDOW + 1) // step)
            first = window * step
            before = np.r_[attention_lm.START_ID, ids][first : t + 1]
            want = model.log_classes(classes.row[before][None], classes.of[ids[first : t + 1]][None])[0, -1]
            assert got[s + t] == pytest.approx(want, abs=1e-4)
    # a distribution, and no id sees a later one
    x = classes.row[flat[6:70]][None]
    every = sum(np.exp(model.log_classes(x, np.full(x.shape, c))) for c in range(attention_lm.CLASSES))
    assert every == pytest.approx(np.ones(x.shape), abs=1e-3)


def base_rows(docs):
    known = Counter()
    rows = []
    for d, text in docs:
        words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER)) + [None]
        held = zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0
        rows.append((d, held, words))
        if not held:
            known.update(words)
    n, v = sum(known.values()), len(known)
    return Counter(
        (d, held, len(w), sum(known[t] > 0 for t in w), n, round(sum(math.log10((known[t] + 0.1) / (n + 0.1 * (v + 1))) for t in w), 6))
        for d, held, w in rows
    )


def model_rows(frame):
    rows = frame.collect()
    assert all(r["score"] is not None and math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    return Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)


@pytest.mark.parametrize("chunk", [1 << 21, 300])
def test_counts_and_base_scores(spark, odd_documents, monkeypatch, chunk):
    monkeypatch.setattr(attention_lm, "CHUNK_WORDS", chunk)
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert model_rows(attention_lm.score(spark, odd_documents.repartition(2))) == base_rows(docs)


def test_every_training_word_trains(spark):
    """Each word and end symbol of the training texts is what is to be said once, after the word before it."""
    import public_tokenizers

    rng = random.Random(12)
    docs = [(i, " ".join(rng.choice(["alpha", "the", "antidisestablishment", "x9"]) for _ in range(rng.choice([0, 1, 64, 65, 300])))) for i in range(60)]
    frame = spark.createDataFrame(docs, DOCS).repartition(2)
    path = public_tokenizers.path("word_bpe_49k.json")
    words = [b"alpha", b"the", b"antidisestablishment", b"x9"]
    flat, many = attention_lm.word_ids(path)(words)
    first = dict(zip(words, flat[np.cumsum(many) - many].tolist(), strict=True))
    want = Counter()
    for i, text in docs:
        if zlib.crc32(str(i).encode()) % 10:
            heads = [attention_lm.START_ID, *(first[w] for w in text.encode().split()), attention_lm.END_ID]
            want.update(zip(heads, heads[1:], strict=False))
    batch = attention_lm.chunks(frame, path, 8).where("windows is not null").select("n", "windows").toArrow().to_batches()
    got = Counter()
    for group in attention_lm.opened(iter(batch)):
        for row in group[:, 0].tolist():
            got.update((a, b) for a, b in zip(row, row[1:], strict=False) if b != attention_lm.PAD)
    assert got == want


def test_an_empty_table_and_one_without_training_texts(spark, odd_documents):
    assert attention_lm.score(spark, odd_documents.limit(0)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    docs = [(held, "Some words <|endoftext|>   x"), (held, None)]
    found = attention_lm.score(spark, spark.createDataFrame(docs, DOCS))
    assert model_rows(found) == base_rows(docs)


def test_model_learns_from_context(spark):
    """Texts of two sorts with words of their own in cycles: what comes next follows from what was before."""
    rng = random.Random(9)
    sorts = [["red", "green", "blue", "white", "black"], ["one", "two", "three", "four", "five"]]
    docs = []
    for i in range(400):
        words, at = sorts[i % 2], rng.randrange(5)
        docs.append((i, " ".join(words[(at + k) % 5] for k in range(60))))
    found = attention_lm.score(spark, spark.createDataFrame(docs, DOCS).repartition(2))
    held = [r for r in found.collect() if r["held_out"]]
    assert len(held) > 20
    assert sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)
    again = {(r["doc_id"], r["score"]) for r in attention_lm.score(spark, spark.createDataFrame(docs, DOCS).repartition(2)).collect()}
    assert {(r["doc_id"], r["score"]) for r in held} <= again  # reruns agree
