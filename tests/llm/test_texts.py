"""Operators on texts against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, outliers, packing, pii, simhash, substrings, tokens
from tests.llm.corpus import awkward, documents, empty, texts


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def found(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- SimHash -----------------------------------------------------------------------------------------------------------

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, linked):
    label = list(range(len(ids)))
    for a, b in linked:
        x, y = label[a], label[b]
        if x != y:
            label = [min(x, y) if v in (x, y) else v for v in label]
    least = defaultdict(list)
    for i, v in zip(ids, label):
        if i is not None:
            least[v].append(i)
    return [min(least[v]) if least[v] else None for v in label]


def test_simhash(spark):
    rows = awkward()
    fps = [brute_fingerprint(t) for _, t in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    want = [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, brute_components([i for i, _ in rows], near))]
    assert found(simhash.near_duplicates(documents(spark, rows))) == sorted(want, key=repr)
    kept = simhash.representatives(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    # One of each group; the two texts of id 8 are groups of their own.
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*{c for _, _, c in want}, 8])
    assert simhash.near_duplicates(empty(spark)).collect() == []


def test_vantage_point_trees_find_every_near_pair(spark):
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for flips in (1, 2, 3, 4):
        own = fps[:400].copy()
        for _ in range(flips):
            own ^= np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)
        fps = np.concatenate([fps, own])
    fps = np.unique(fps)
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    label = np.arange(len(fps))
    while (label[i] != label[j]).any():
        np.minimum.at(label, i, label[j])
    signed = fps.view(np.int64)
    df = spark.createDataFrame([(int(f),) for f in signed], "fp long").repartition(4)
    for options in ({"leaf_rows": 50}, {"leaf_rows": 50, "max_sample": 64}):  # the second needs salted leaves
        got = {r.node: r.component for r in simhash.link(df, **options).collect()}
        groups = defaultdict(set)
        for f, v in zip(signed.tolist(), label.tolist()):
            groups[v].add(f)
        assert got == {f: min(g) for g in groups.values() if len(g) > 1 for f in g}


# --- repeated passages ---------------------------------------------------------------------------------------------------

def brute_removals(rows, window=50):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for at in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[at:at + window])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for at in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[at:at + window])] < i:
                gone[at:at + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), sha(b" ".join(kept))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_passages(spark, seed):
    rows = awkward(seed)
    got = found(substrings.removals(documents(spark, rows)))
    want = brute_removals(rows)
    assert got == want and sum(r[2] for r in want) > 500


def test_texts_without_repeats(spark):
    rows = awkward(3)
    docs = documents(spark, rows)
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns
    digest = {r[3] for r in brute_removals(rows)}
    changed = 0
    for r in out.collect():
        assert sha(b" ".join((r.text or "").encode().split())) in digest
        changed += r.text not in {t for _, t in rows}
    assert changed > 5
    assert substrings.removals(empty(spark)).collect() == []


def test_equal_windows_have_equal_symbols():
    words = [t.encode().split() for t in texts(9, 120)]
    names, edge, begin, end = substrings._laid_out(words)
    starts = np.zeros(len(names), dtype=bool)
    for b, e in zip(begin, end):
        starts[b:max(b, e - 49)] = True
    symbol, first, n = substrings.anchors(names, edge, starts)
    at = np.concatenate([np.arange(f, f + k) for f, k in zip(first, n)])
    assert (at == np.flatnonzero(starts)).all()
    of = {}
    for p, s in zip(at, np.repeat(symbol, n)):
        assert of.setdefault(tuple(names[p:p + 50]), s) == s
    assert len(first) < len(at) / 4


# --- byte-level BPE and packing ------------------------------------------------------------------------------------------

ODD = ["", " ", "  x", "a  b", "it's we'll", "\n\n x\r\n", "1234 5 漢字é", "<|endoftext|>", "\x85 \x1c\x1d", "a" * 700, "ab" * 300,
       " " * 333, "\u2003 \u00a0z", "👍🏽 ok", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>\n", "<|endoftext |>"]


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.model().ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, reference):
    rows = awkward() + [(1000 + k, t) for k, t in enumerate(ODD)]
    docs = documents(spark, rows)
    ids = {t: reference.encode_ordinary(t or "") for _, t in rows}
    want = [(i, len(ids[t]), sha(" ".join(map(str, ids[t]))), sha((t or "").encode())) for i, t in rows]
    assert found(bpe.digests(docs)) == sorted(want, key=repr)
    some = documents(spark, [(k, t) for k, t in enumerate(ODD)] + [(99, None)])
    encoded = bpe.encode(some)
    got = {r.doc_id: list(r.ids) for r in encoded.collect()}
    assert got == {k: ids[t] for k, t in enumerate(ODD)} | {99: []}
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(encoded).collect()}
    assert back == {k: t.encode() for k, t in enumerate(ODD)} | {99: b""}
    assert bpe.digests(empty(spark)).collect() == []


@pytest.mark.parametrize("special", [True, False])
def test_whole_texts_are_encoded_as_by_the_plain_call(special):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, own = Tokenizer.from_file(path), tokens.ByteBpe(path, special)
    plain.encode_special_tokens = not special
    assert own.fast is not None
    for t in texts(3, 40) + ODD:
        want = plain.encode(t, add_special_tokens=False).ids
        assert own.ids(t).tolist() == want
    # Too long for the library's pattern: match by match.
    long = " " * 3_000_000 + "x <|endoftext|>"
    ids = own.ids(long)
    assert b"".join(own.bytes_of.get(i, b"<|endoftext|>") for i in ids.tolist()) == long.encode()
    assert (50256 in ids) == special


def test_pieces_are_encoded_like_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    cache = tokens.PieceCache(tokens.tokenizer_encoder(path), limit=50)
    sample = texts(3, 40) + ODD
    for part in (sample[:20], sample[20:], sample):  # the small limit empties the cache in between
        got = [np.frombuffer(b"".join(v), "<u4").tolist() for v in cache.look_up(part)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in part]


def test_matches_are_encoded_once():
    asked = Counter()

    def encode(words):
        asked.update(words)
        return [w.encode() for w in words]

    cache = tokens.PieceCache(encode, limit=40)
    for part in (["so it is", " it, is.\n"], ["it: so; is", "is it\n\nso?"], ["", " it. is!"]):
        assert [b"".join(v).decode() for v in cache.look_up(part)] == part
    assert max(asked.values()) == 1  # a match stands in many pieces
    for k in range(40):  # what is asked for again and again stays when the cache makes room, the others go
        assert [b"".join(v).decode() for v in cache.look_up([f"so it is, x{k}y{k}"])] == [f"so it is, x{k}y{k}"]
        assert len(cache.known.young) + len(cache.known.old) < 60 and len(cache.words.young) + len(cache.words.old) < 60
    assert all(asked[w] == 1 for w in ("so", " it", " is", ","))
    cache.look_up(["it: so; is"])
    assert asked["it"] == 2


def test_bpe_of_long_and_repeated_matches(reference):
    own = bpe.Bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdeéstñ漢"), n)) for n in (1, 2, 3, 30, 129, 400, 1500)] + ["a" * 3000, " ", "\x00", "s" * 64]
    word, ids = own.encode_words(words)
    assert [ids[word == k].tolist() for k in range(len(words))] == [reference.encode_ordinary(w) for w in words]
    assert own.decode(word, ids, len(words) + 1) == [w.encode() for w in words] + [b""]
    assert own.values([]) == []


def test_packing(spark):
    import zlib
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = awkward() + [(1000 + k, t) for k, t in enumerate(ODD)]
    packed = packing.pack_documents(documents(spark, rows), with_ids=True).cache()
    pieces, ids = defaultdict(list), Counter()
    for r in packed.collect():
        assert r.length == len(r.ids) and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        pieces[r.sequence_id].append((r.offset, r.length))
        ids[(r.doc_id, r.start, r.doc_tokens, tuple(r.ids))] += 1
    for own in pieces.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1]) and sum(n for _, n in own) <= 1024
    assert sorted(pieces) == list(range(len(pieces)))
    want = Counter()
    for i, t in rows:
        whole = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(whole), 1024):
            want[(i, at, len(whole), tuple(whole[at:at + 1024]))] += 1
    assert ids == want
    assert sum(n for own in pieces.values() for _, n in own) / (1024 * len(pieces)) > 0.9
    sequences = packing.sequences(packed).collect()
    assert len(sequences) == len(pieces) and sum(len(r.ids) for r in sequences) == sum(k[2] * 0 + len(k[3]) * c for k, c in want.items())
    assert packing.pack_documents(empty(spark)).collect() == []


def test_patterns_hold_the_histogram():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 1025, 500), [1] * 5000, [1024], [513] * 9 + [511] * 4, []):
        histogram = Counter(map(int, lengths))
        left = Counter()
        for count, own in packing.patterns(histogram):
            assert sum(own) <= 1024 and count > 0
            for n in own:
                left[n] += count
        assert left == histogram


# --- quality rules -------------------------------------------------------------------------------------------------------

def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside))


def test_base_statistics(spark):
    rows = awkward() + [(900, "x|y\nx|y\n \n \nx|y#\n*"), (901, "a b c a b c a"), (902, "é ü\vö\f漢字 𝒳")]
    got = found(outliers.judged(documents(spark, rows)).select("doc_id", *outliers.BASE, "base_failed"))
    want = []
    for i, t in rows:
        s = brute_statistics(t)
        want.append((i, *s, s[0] < 50 or 100 * s[4] > 50 * s[0]))
    assert got == sorted(want, key=repr)
    assert outliers.judged(empty(spark)).collect() == []


def test_chi_square():
    assert outliers.chi_square_quantile(0.5, 5) == pytest.approx(4.35146, abs=1e-4)
    assert outliers.chi_square_quantile(0.95, 7) == pytest.approx(14.0671, abs=1e-3)


def brute_estimate(x, steps=5, coverage=0.75):
    """The same concentration steps on whole arrays, without cells: h nearest rows by sorting."""
    floors = np.diag(np.square(outliers.FLOORS))
    scale = coverage / outliers.chi_square(outliers.chi_square_quantile(coverage, 5), 7)
    mid = np.median(x, axis=0)
    dev = (np.quantile(x, 0.84, axis=0) - np.quantile(x, 0.16, axis=0)) / 2
    best = None
    for loc, cov in ((x.mean(axis=0), np.cov(x.T, bias=True) + floors), (mid, np.diag(dev ** 2) + floors)):
        for _ in range(steps):
            d = np.einsum("ij,jk,ik->i", x - loc, np.linalg.inv(cov), x - loc)
            own = x[np.argsort(d)[:int(np.ceil(coverage * len(x)))]]
            loc, cov = own.mean(axis=0), scale * np.cov(own.T, bias=True) + floors
        best = min(best or (np.inf,), (np.linalg.slogdet(cov)[1], loc.tolist(), cov.tolist()))
    return np.array(best[1]), np.array(best[2])


def test_robust_estimates_and_verdicts(spark):
    rng = np.random.default_rng(5)
    clean = rng.normal(size=(2000, 5)) @ np.diag([0.05, 0.1, 0.3, 0.02, 0.8]) + [1.6, 0.2, 0.3, 0.02, 5.5]
    spoiled = clean.copy()
    spoiled[:400] += [0.8, 5, 0, 0, 0]
    rows = [(g, *map(float, v)) for g, x in ((1, clean), (2, spoiled)) for v in x]
    got = {r.grp: r for r in outliers.estimates(spark.createDataFrame(rows, "grp long, x0 double, x1 double, x2 double, x3 double, x4 double")).collect()}
    for g, x in ((1, clean), (2, spoiled)):
        loc, cov = brute_estimate(x)
        inverse = np.linalg.inv(cov)
        limit = outliers.chi_square_quantile(1 - 1e-9, 5)
        mine = np.array(got[g].prec).reshape(5, 5)
        kept = [np.einsum("ij,jk,ik->i", x - m, p, x - m) <= limit for m, p in ((loc, inverse), (np.array(got[g].loc), mine))]
        assert np.allclose(got[g].loc, loc, atol=0.02) and (kept[0] == kept[1]).mean() > 0.999
        assert not kept[1][:400].any() if g == 2 else kept[1].all()


def test_outliers_are_rejected(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aeilmnorst"), rng.integers(2, 9))) for _ in range(500)]
    rows = [(k, " ".join(rng.choice(words, 80 + k))) for k in range(150)] + [(k, " ".join(w + "###" for w in rng.choice(words, 90))) for k in range(150, 156)]
    docs = documents(spark, rows).withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string"))
    got = {r.doc_id: r.kept for r in outliers.judged(docs).collect()}
    assert {k for k, v in got.items() if not v} == set(range(150, 156))
    kept = outliers.keep(docs)
    assert kept.columns == docs.columns and kept.count() == 150


def test_small_last_pools_are_judged(spark):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("aeilmnorst"), rng.integers(2, 9))) for _ in range(500)]
    odd = lambda n: " ".join(w + "###" for w in rng.choice(words, n))
    rows = [(k, " ".join(rng.choice(words, 80 + k % 150))) for k in range(160)] + [(k, odd(90)) for k in range(160, 166)]
    for en in (150, 0):  # a last pool beside a large group, and a table smaller than a group
        lang = F.when(F.col("doc_id") < en, "en").otherwise(F.concat(F.lit("l"), F.col("doc_id") % 5))
        docs = documents(spark, rows if en else rows[:60] + rows[-6:]).withColumn("lang", lang).withColumn("source", F.lit("s"))
        got = {r.doc_id: r.kept for r in outliers.judged(docs).collect()}
        assert {k for k, v in got.items() if not v} == set(range(160, 166))


# --- personal data ---------------------------------------------------------------------------------------------------------

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes_luhn(digits):
    doubled = [int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def brute_spans(text):
    out = []
    for no, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and passes_luhn(digits) or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), no, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


def test_personal_data(spark):
    import random
    rng = random.Random(3)
    bits = ["a.b@c.d", "x@y", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (724) 555-7058",
            "+12", "+1 2 3 4 5 6 7 8 9 0", "é", "漢字", "𝒳", " ", "\n", ".", ",", "id=", "Ref: ", "12", "@", "0001.0.0.255",
            "99999999999999999999999999.1.1.1", "4111111111111111"]
    rows = awkward() + [(2000 + i, "".join(rng.choices(bits, k=rng.randint(0, 14)))) for i in range(400)]
    rows += [(5003, "1 " * 30_000), (5004, "9" * 50_000), (5005, "a." * 20_000 + "@b.c" + ".d" * 20_000)]
    want = []
    for i, t in rows:
        s = brute_spans(t)
        want.append((i, *[sum(x.startswith(k + ":") for x in s) for k in KINDS], sha(",".join(s))))
    got = pii.personal_data(documents(spark, rows)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    assert pii.personal_data(empty(spark)).collect() == []


def test_addresses_in_very_long_texts(spark):
    import time
    n = 1_000_000
    rows = [(1, "a" * n + " x@ y me@host.org"), (2, "b" * n + "@"), (3, "c" * n + "@d.e"), (4, "a@b.c" * 50_000)]
    start = time.time()
    got = {r.doc_id: (r.n_email, r.spans) for r in pii.personal_data(documents(spark, rows)).collect()}
    assert time.time() - start < 60
    assert got[1] == (1, f"email:{n + 6}:{n + 17}") and got[2][0] == 0 and got[3] == (1, f"email:0:{n + 4}")
    assert got[4][0] == len(re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", rows[3][1]))


def test_bootstrapped_patterns_find_more(spark):
    rows = [(i, f"the Ref: user{i}@mail.org and more") for i in range(12)]
    rows += [(20, "see Ref: (QX-9931-77), ok"), (21, "note: hello 5"), (22, "Ref: none"), (23, "at: 77-88")]
    rows += [(100 + i, f"note: {w}") for i, w in enumerate("one two a1@b.c three".split())]
    got = {r.doc_id: r.spans for r in pii.personal_data(documents(spark, rows)).collect()}
    assert got[20] == "other:10:20" and got[3] == "email:9:23"
    assert [k for k, v in got.items() if "other" in v] == [20]
    docs = documents(spark, rows + [(200, None), (201, "ip 1.2.3.4 card 4111111111111111 mail a.b@c.d.")])
    masked = pii.masked(docs)
    text = {r.doc_id: r.text for r in masked.collect()}
    assert masked.columns == docs.columns and text[20] == "see Ref: ([OTHER]), ok" and text[200] is None
    assert text[201] == "ip [IP] card [CARD] mail [EMAIL]." and text[21] == "note: hello 5"
