"""Operators against plain versions of what they compute."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from termloom.llm import bpe, decontaminate, fingerprints, licenses, near_dedup, pii, queries, quality, token_files, toxicity

RANKS = bpe.load_ranks(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
ODD = ["'re", "s", "'", "r", " ", "  ", "\n", "\t", "a", "Zürich", "中", "1", "23", "!", "\x1c", "\x85", "  \n ", "'ll", "🙂", " " * 9, "<|endoftext|>", "ab" * 30]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def _odd_texts(count=300, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def test_bpe_is_that_of_the_library(texts, monkeypatch):
    monkeypatch.setattr(bpe, "LEAF", 7)
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    for text in [*_odd_texts(), "a" * 3000, "ab" * 1500, *itertools.islice(texts.values(), 60)]:
        ids = np.frombuffer(encoder.encode(text), "<u4")
        assert ids.tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_bpe_query(spark, sf_dir, texts):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    rows = queries.op5_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("top", [2, 5, 300, 50_257, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 3, 59, 61, 8191, 8192, 8193, 20_000])
def test_simple8b_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    ids[: n // 3] = 0
    words, escapes, offsets = token_files.pack(ids)
    assert (token_files.unpack(words, escapes, offsets, n) == ids).all()
    assert len(offsets) == 24 * -(-n // token_files.BLOCK_IDS)


def test_word_encoder_is_the_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    odd = _odd_texts(seed=2)
    for text, ids in zip(odd, token_files.WordEncoder(path).encode(odd)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files_query(spark, sf_dir, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    start, expected = 0, []
    for doc in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[doc], add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.op3_token_files(spark, sf_dir).collect())) == expected


def _set(text, size):
    words = (text or "").encode().lower().split()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def _components(texts, size, percent):
    sets = {d: _set(t, size) for d, t in texts.items()}
    top = {d: d for d in sets}

    def root(d):
        while top[d] != d:
            d = top[d]
        return d

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((root(a), root(b)))
            top[b] = a
    return {d: (len(sets[d]), root(d)) for d in sets}


def _near_copies():
    """A chain and a group about the threshold, copies, and texts that share a passage."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    rows = {}
    for k in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(9000)}"
        rows[k] = " ".join(own)
    for k in range(60, 80):
        rows[k] = " ".join(base[:40] + [f"y{rng.randrange(9000)}" for _ in range(80)])
    return rows | {90: "a b", 91: "A  b", 92: "", 93: "a", 94: rows[3], 95: rows[3].upper()}


@pytest.mark.parametrize("block", [4, 512])
@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, block, size, percent, monkeypatch):
    monkeypatch.setattr(near_dedup, "SLICE", block)
    monkeypatch.setattr(near_dedup, "SALTS", block)
    rows = _near_copies()
    docs = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, size, percent).collect()}
    assert found == _components(rows, size, percent)


def test_bayesian_bounds():
    bounds, count = near_dedup.needed_matches(0.85, 1e-6), near_dedup.hashes_for(0.85, 1e-6)
    assert list(bounds) == sorted(bounds) and bounds[-1] < 0.85 * count
    rng = np.random.default_rng(0)
    left = rng.integers(0, 2**32, (2000, count), dtype=np.uint32)
    right = np.where(rng.random(left.shape) < 0.85, left, 0)
    assert len(near_dedup.plausible(left, right, bounds)) == 2000
    right = np.where(rng.random(left.shape) < 0.4, left, 0)
    assert len(near_dedup.plausible(left, right, bounds)) < 20


@pytest.mark.parametrize("percent, miss", [(85, 1e-6), (80, 1e-6), (80, 1e-9), (50, 1e-6), (95, 1e-6), (100, 1e-6)])
def test_bands_keep_pairs_of_the_threshold(percent, miss):
    bands = near_dedup.hashes_for(percent / 100, miss) / near_dedup.BAND
    assert (1 - (percent / 100) ** near_dedup.BAND) ** bands <= miss


@pytest.mark.parametrize("block_bytes", [300, decontaminate.BLOCK_BYTES])
def test_decontamination(spark, block_bytes):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 2)
    items = {i: " ".join(word() for _ in range(rng.choice([1, 3, 8, 13, 20]))) for i in range(20)}
    docs = {
        d: " ".join([word() for _ in range(30)] + items[rng.randrange(20)].upper().split() + [word() for _ in range(rng.randrange(60))])
        for d in range(40)
    }
    frame = lambda rows, names: spark.createDataFrame(list(rows.items()), names)
    found = decontaminate.decontaminate(
        frame(docs, "doc_id bigint, text string"), frame(items, "item_id bigint, text string"), block_bytes
    )
    for r in found.collect():
        words, hit, names = docs[r.doc_id].lower().split(), set(), set()
        for item, text in items.items():
            own = text.lower().split()
            size = min(13, len(own))
            for i, p in itertools.product(range(len(own) - size + 1), range(len(words) - size + 1)):
                if own[i : i + size] == words[p : p + size]:
                    hit.update(range(p, p + size))
                    names.add(str(item))
        assert (r.n_words, r.n_hit, r.item_ids) == (len(words), len(hit), sorted(names))
        assert r.contaminated == (20 * len(hit) >= len(words) and bool(hit))


def test_fingerprints(spark, sf_dir, texts):
    rows = sorted(queries.op8_fingerprints(spark, sf_dir).collect(), key=lambda r: r.doc_id)
    docs, errors = sorted(texts), []
    assert [r.doc_id for r in rows] == docs
    for k, r in enumerate(rows):
        text, following = texts[docs[k]], texts[docs[(k + 1) % len(docs)]]
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.edited_fingerprint == fingerprints.fingerprints([changed])[0]
        a, b = _set(text, 5), _set(changed, 5)
        errors.append(r.near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def _base_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(_PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and _luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]:
                out.append((m.start(), number, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_pii(spark, texts):
    rng = random.Random(6)
    parts = ["a@b.c", "_d@e.f", "1.2.3.4", ".5.6", "300.1.1.1", "4111111111111111", "4111 1111 1111 1111", "-", " ", "+1 (319) 555-5132", "é", "😀", "x", "@", "+", "0", "001.2.3.255", "token = \"ab12cd34ef56\""]
    odd = {10**6 + k: "".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for k in range(300)}
    odd[10**7] = "7" * 30_000 + "q" * 30_000 + "@"
    rows = texts | odd
    docs = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    found = pii.find(docs, pii.train(docs)).select(
        "doc_id", pii.span_text(pii.F.col("base_spans")).alias("base"), pii.span_text(pii.F.col("spans")).alias("spans")
    ).collect()
    for r in found:
        assert r.base == _base_spans(rows[r.doc_id])
        assert set(r.base.split(",")) - {""} <= set(r.spans.split(","))


def test_expectation_maximisation_finds_the_good_labelers():
    rng = random.Random(8)
    counts = {}
    for _ in range(4000):
        truth = rng.random() < 0.5
        votes = "".join("y" if (rng.random() < right) == truth else "n" for right in (0.9, 0.9, 0.9, 0.5, 0.5))
        counts[votes] = counts.get(votes, 0) + 1
    belief = pii.estimate(sorted(counts.items()))
    assert belief["yyynn"] > 0.9 and belief["nnnyy"] < 0.1


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_matcher_is_edit_distance():
    terms = ["idiot", "pathetic", "scum", "loser", "worthless"]
    matcher = toxicity.Matcher(terms)
    rng = random.Random(2)
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "i", "0"])
        word = "".join(word)
        best = min((_distance(word, t), k) for k, t in enumerate(terms) if _distance(word, t) <= matcher.edits_of(t)) if any(
            _distance(word, t) <= matcher.edits_of(t) for t in terms
        ) else None
        assert matcher.match(word) == (best and (best[1], best[0]))


def test_quotation_lowers_the_score():
    scorer = toxicity.Scorer([("idiot", 5.0), ("scum", 5.0)])
    weigh = lambda text: toxicity._PRIOR[0] + np.dot(toxicity._PRIOR[1:], scorer.features(text))
    plain, quoted, wrong = weigh("you idiot and scum"), weigh('they said "you idiot and scum" there'), weigh("you idoit and scum")
    assert plain > quoted and plain > weigh("nothing at all") and wrong >= weigh("you and scum")


@pytest.mark.parametrize("query, label, threshold", [(queries.op1_toxicity, "toxic", 0.9), (queries.op9_quality, "quality", 0.9)])
def test_held_out_accuracy(spark, query, label, threshold):
    folder = "/root/testdata/sf0.1"
    scored = query(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = scored.select("predicted", label, "score").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r[label] for r in rows) / len(rows) > threshold


def test_licenses(spark):
    gpl = licenses.TEMPLATES["GPL-3.0"]
    rows = [(1, f"some words {gpl} more words {gpl}"), (2, gpl.replace("work", "text")), (3, "the license"), (4, " ".join(licenses.TEMPLATES["BSD"].split()[:10]))]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert (found[1].license, found[1].coverage, found[1].first_word, found[1].n_licenses) == ("GPL-3.0", 1.0, 2, 1)
    assert found[2].license == "GPL-3.0" and 0.9 < found[2].coverage < 1
    assert found[3].license is None and found[4].license is None


def test_alignment_is_increasing():
    pairs = licenses.align(list("abcxdefg"), list("abcdyefg"))
    assert pairs == sorted(pairs) and [t for _, t in pairs] == [0, 1, 2, 3, 5, 6, 7]
    assert licenses.increasing([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])

