import base64
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from critiq.llm import compression_bands as bands
from critiq.llm import packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_stats(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_base_stats_equal_a_plain_count():
    rng = random.Random(1)
    texts = ["", " ", "a", "a b c a b c a", "x\nx\n\n \n \nx", " a b \x1c c\x85d", "##<> é é\n é é"]
    texts += [" ".join(rng.choice("ab#") for _ in range(rng.randint(0, 40))) + rng.choice("\n ") for _ in range(300)]
    for text in texts:
        assert bands.base_stats(text.encode()) == plain_stats(text)


def test_bands_reject_repetitive_and_incompressible_text_and_keep_prose():
    import zstandard

    rng, compress = random.Random(2), zstandard.ZstdCompressor(level=3).compress
    noise = base64.b64encode(rng.randbytes(9000)).decode()
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(800)]
    natural = " ".join(rng.choice(vocabulary[: rng.randint(1, 800)]) for _ in range(4000))
    assert bands.compression_verdict(natural.encode(), compress)[0]
    assert not bands.compression_verdict(("the same words again " * 400).encode(), compress)[0]
    assert not bands.compression_verdict(noise.encode(), compress)[0]
    # half prose, half one word: the chunks tell
    mixed = natural[:12_000] + "spam " * 2500
    verdict, _, bad = bands.compression_verdict(mixed.encode(), compress)
    assert not verdict and bad >= 12_000


def test_quality_rules_on_odd_documents(spark, odd_documents):
    got = bands.quality_rules(odd_documents).collect()
    assert len(got) == odd_documents.count()
    texts = odd_documents.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *plain_stats(r.text)) for r in texts)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    clean = bands.keep_clean(odd_documents)
    assert clean.columns == odd_documents.columns
    assert clean.count() == sum(r.kept for r in got)
    assert bands.quality_rules(odd_documents.limit(0)).count() == 0


def fill(plan, counts, capacity):
    used, sequences = Counter(), {}
    for w, rank, n, first, per, offset in sorted(plan.rows):
        assert used[w] == rank
        used[w] += n
        for k in range(n):
            sequences.setdefault(first + k // per, []).append((offset + k % per * w, w))
    assert used == Counter(counts)
    for pieces in sequences.values():
        at = 0
        for offset, w in sorted(pieces):
            assert offset == at
            at += w
        assert at <= capacity
    assert sorted(sequences) == list(range(plan.sequences))


def fewest(items, capacity):
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= items[i]}:
            rest = list(rooms)
            rest.remove(room)
            place(i + 1, [*rest, room - items[i]])
        place(i + 1, [*rooms, capacity - items[i]])

    items = sorted(items, reverse=True)
    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(3))
def test_reduction_keeps_an_optimal_packing(seed):
    rng = random.Random(seed)
    for _ in range(200):
        capacity = rng.choice([10, 20, 50])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        counts = Counter(items)
        fill(packing.Plan(dict(counts), capacity).run(), counts, capacity)
        reduced = packing.Plan(dict(counts), capacity)
        reduced.reduce()
        rest = [w for w, n in reduced.left.items() for _ in range(n)]
        assert fewest(items, capacity) == reduced.n_fixed + fewest(rest, capacity)


def test_plan_is_near_the_bound_and_small():
    rng = np.random.default_rng(0)
    lengths, n = np.unique(np.minimum(4096, rng.lognormal(6, 1.2, 300_000).astype(int) + 1), return_counts=True)
    counts = dict(zip(lengths.tolist(), n.tolist(), strict=True))
    plan = packing.Plan(counts, 4096).run()
    fill(plan, counts, 4096)
    assert plan.sequences <= 1.001 * -(-int((lengths * n).sum()) // 4096)
    assert len(plan.rows) < 8 * 4096
    assert packing.Plan({}, 4096).run().sequences == 0


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer, ids = Tokenizer.from_file(path), packing.word_encoder(path)
    rng = random.Random(3)
    texts = ["", " ", "İstanbul ſtraße ŉ", "<|endoftext|> a", "don't can’t I'll", "ΣΑΣ ΟΔΟΣ.", "a\x1cb\x85c", "日本語", "😀!!?", "x" * 500]
    texts += ["été ́a", "ﬁ ½ Ⅷ", "word...,;", "ÀÉÎ,. Straße ŁÓDŹ"]
    texts += ["".join(rng.choice("aZé.,' \ńİΣ1-") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    for text in texts:
        assert ids(text.encode()) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_words_of_many_texts_are_looked_up_once():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer, ids = Tokenizer.from_file(path), packing.word_encoder(path, cached_words=3)
    texts = [b"", None, b"The cat, the CAT!\tthe ...", " na\u00efve \u00dcber: x#y \u65e5\u672c cat".encode(), b"  ", b"a" * 60 + b"! cat." + b"!" * 60]
    for _ in range(2):  # what is kept goes after three words
        flat, many = ids.many(texts)
        each = np.split(flat, np.cumsum(many)[:-1])
        assert [x.tolist() for x in each] == [tokenizer.encode((t or b"").decode(), add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in ids.many([])] == [[], []]


def test_pack_round_trip(spark, odd_documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    got = packing.pack(spark, odd_documents).collect()
    want = Counter()
    for r in odd_documents.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), 4096):
            piece = ids[k : k + 4096]
            want[r.doc_id, k // 4096, k, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= 4096
    assert packing.pack(spark, odd_documents.limit(0)).count() == 0



def test_noise_is_rejected_where_prose_is_clear_of_it():
    import zstandard

    compress = zstandard.ZstdCompressor(level=bands.LEVEL).compress
    rng = random.Random(41)

    def words(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(n // 6))[:n].encode()

    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    for noise, least in ((letters, 2500), (digits + "abcdef", 9000), (digits, 17_000), (letters + letters.upper() + digits + "+/", 700)):
        for n in (least, 2 * least, 8 * least):
            assert not bands.compression_verdict(words(noise, n), compress)[0], (noise, n)
    # a quarter of noise within prose is found by its chunks
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(900)]
    prose_of = lambda n: " ".join(rng.choice(vocabulary[: rng.randint(1, 900)]) for _ in range(n // 5))[:n].encode()
    for n in (300, 900, 3000, 6000, 12_000, 40_000):
        assert bands.compression_verdict(prose_of(n), compress)[0], n
    mixed = prose_of(16_384) + words(letters, 8192) + prose_of(8192)
    assert not bands.compression_verdict(mixed, compress)[0]
