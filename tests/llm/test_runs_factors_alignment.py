"""Periodic runs, relative Lempel-Ziv factors and token alignment against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from cases import documents, edge_rows, prose, save  # noqa: E402
from occuflow.llm import periodic, relative_lz, token_alignment  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def periodic_rows():
    rng = random.Random(11)
    rows = [(i, t, s) for i, t, s in edge_rows()]
    for i in range(60):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        rows.append((1000 + i, " ".join(words), "a"))
    unit = prose(20, 7)
    rows += [(2000, " ".join([unit] * 9) + " tail", "a"), (2001, "a b " * 400 + "a a " * 300, "b"),
             (2002, "\n".join(["x y z x y z"] * 8), "c"), (2003, prose(21, 3000), "a")]
    return rows


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    data = periodic_rows()
    return data, save(spark, tmp_path_factory.mktemp("runs"), data)


# 11 -----------------------------------------------------------------------

def runs_of(words, min_words=6, exponent=4):
    """All runs (start, length, period), by every period and every stretch."""
    best, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_words, exponent * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    n = len(words)
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def test_runs_of_the_query(spark, rows):
    data, folder = rows
    got = Counter(tuple(r) for r in periodic.op11_periodic_runs(spark, folder).collect())
    want = Counter()
    for i, t, _ in data:
        words = planted(i, WORD.findall(t or ""))
        runs = runs_of(words)
        best = min(runs, key=lambda r: (-(r[1] * 10 ** 12 // r[2]), r[0], r[2]), default=(None,) * 3)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
        want[(i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(listed), sha(collapsed(words, runs)))] += 1
    assert got == want
    assert any(r[1] > 1 for r in want)


@pytest.mark.parametrize("min_words,exponent", [(6, 4), (4, 3), (2, 5), (9, 3)])
def test_runs_on_random_words(min_words, exponent):
    rng = random.Random(min_words)
    for size in [*range(0, 40), 300]:
        words = [rng.randint(0, 1 + size % 3) for _ in range(size)] + [7] * (size % 7) + [8, 9] * (size % 5)
        codes = np.array(words, dtype=np.int64)
        place, length, period = periodic.find_runs(codes, np.zeros(len(codes), np.int64), min_words, exponent)
        assert sorted(zip(place.tolist(), length.tolist(), period.tolist())) == runs_of(words, min_words, exponent)


def test_runs_stay_in_their_text_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, [(1, "a a a", "x"), (2, "a a a", "x"), (3, "b " * 6, "x"), (4, None, "y")])
    docs = docs.withColumn("runs", F.lit(1)).withColumn("n_words", F.lit("n")).withColumn("__text", F.lit("z z z z z z"))
    got = {r["doc_id"]: r for r in periodic.periodic_runs(docs).collect()}
    assert [len(got[i]["runs"]) for i in (1, 2, 3, 4)] == [0, 0, 1, 0]
    assert got[3]["collapsed"] == "b" and got[4]["collapsed"] == "" and got[3]["n_words"] == 6
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, exponent=2)


# 12 -----------------------------------------------------------------------

def removed_words(data, length=20):
    """Kept words per row, by every window's earliest start."""
    first = {}
    order = lambda i: (i is None, i or 0)
    texts = [(i, WORD.findall(t or "")) for i, t, _ in data]
    for i, w in texts:
        for s in range(len(w) - length + 1):
            k = tuple(w[s:s + length])
            first[k] = min(first.get(k, (order(i), s)), (order(i), s))
    out = []
    for i, w in texts:
        gone = set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s:s + length])] < (order(i), s):
                gone.update(range(s, s + length))
        out.append((i, w, gone))
    return out


def copied_rows():
    rng = random.Random(12)
    data = edge_rows()
    passage = prose(40, 25)
    for i in range(30):  # a common passage between other words, cut at both ends
        words = passage.split()[rng.randint(0, 3):25 - rng.randint(0, 3)]
        data.append((300 + i, " ".join([prose(500 + i, 12), *words, prose(700 + i, 9)]), "a"))
    spliced = prose(1, 400).split()
    data += [(400, " ".join(spliced[40:75] + spliced[10:45] + spliced[40:75]), "b"), (None, prose(41, 50), "c"),
             (401, "w " * 100, "d"), (401, prose(42, 60) + " " + passage, "d"), (None, prose(41, 50), "c")]
    return data


@pytest.mark.parametrize("length", [20, 7])
def test_repeated_windows(spark, length):
    data = copied_rows()
    rows = relative_lz.remove_repeated_windows(documents(spark, data).repartition(5), length).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows)
    want = Counter((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone)))
                   for i, w, gone in removed_words(data, length))
    assert got == want
    # every factor copies an earlier place, and the factors are what went
    texts = {}
    for i, t, _ in data:
        texts.setdefault(i, []).append(WORD.findall(t or ""))
    for r in rows:
        covered = set()
        own = [w for w in texts[r["doc_id"]] if len(w) == r["n_words"]]
        for f in r["factors"]:
            s, n, other, at = f["start"], f["length"], f["ref_doc_id"], f["ref_start"]
            assert n >= length
            assert any(w[s:s + n] == v[at:at + n] for w in own for v in texts[other])
            assert (other is None, other or 0, at) < (r["doc_id"] is None, r["doc_id"] or 0, s)
            covered.update(range(s, s + n))
        assert len(covered) == r["n_removed"]
        assert (r["kept_text"] is None) == (not r["factors"])


def test_repeated_windows_with_many_flushes(spark):
    """Settling inside tasks changes nothing: one partition, many, and one flush for every slice."""
    data = copied_rows() + [(800 + i, prose(1, 400), "h") for i in range(30)]
    docs = documents(spark, data)
    want = sorted(map(repr, relative_lz.remove_repeated_windows(docs.coalesce(1)).select("doc_id", "n_removed", "kept_sha256").collect()))
    again = relative_lz.remove_repeated_windows(docs.repartition(16)).select("doc_id", "n_removed", "kept_sha256").collect()
    assert sorted(map(repr, again)) == want


def test_repeated_windows_clashing_columns(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, [(1, prose(1, 30), "x"), (2, prose(1, 30), "x")])
    for name in ("doc", "tag", "__text", "key", "block", "place", "n_words"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = {r["doc_id"]: r["n_removed"] for r in relative_lz.remove_repeated_windows(docs).collect()}
    assert got == {1: 0, 2: 30}
    with pytest.raises(ValueError):
        relative_lz.remove_repeated_windows(docs, 3)


# 13 -----------------------------------------------------------------------

def aligned(data):
    """The contract's columns from the tokenizers themselves, pair by pair."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    count, rows = Counter(), []
    for i, text, _ in data:
        row, links = [i, 0, 0, 0, 0, ""], []
        if text:
            a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text, num_threads=1)
            sa = [bytes(byte[c] for c in a_side.id_to_token(x)) for x in a]
            sb = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()
                  for p in map(b_side.id_to_piece, b)]
            if b"".join(sa) == b"".join(sb) == (" " + text).encode():
                ea, eb = np.cumsum([len(x) for x in sa]), np.cumsum([len(x) for x in sb])
                groups, x, y = [], 0, 0
                for end in sorted(set(ea.tolist()) & set(eb.tolist())):
                    u, v = int(np.searchsorted(ea, end)) + 1, int(np.searchsorted(eb, end)) + 1
                    groups.append(",".join(map(str, a[x:u])) + "|" + ",".join(map(str, b[y:v])))
                    links += [(b[q], a[p]) for p in range(x, u) for q in range(y, v)
                              if ea[p] - len(sa[p]) < eb[q] and eb[q] - len(sb[q]) < ea[p]]
                    x, y = u, v
                row = [i, len(a), len(b), len(groups), len(links), sha(";".join(groups))]
        count.update(links)
        rows.append((row, links))
    best = {}
    for (b, _), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return Counter((*r[:5], sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), r[5])
                   for r, links in rows), count


def token_rows():
    return edge_rows() + [
        (500, "a▁b", "a"), (501, "▁", "a"), (502, "<|endoftext|> <s> </s> <unk> <0x41>", "a"), (503, " leading  and  trailing ", "a"),
        (504, "ﬁ① é ​ 漢字かな 🎉🎉 \x00 tab\tnew\r\nline", "a"), (505, "z" * 9000, "b"), (506, " ", "b"),
        (507, "the cat sat on the mat, the cat sat", "c")]


@pytest.mark.parametrize("radix_bits", [0, 4])
def test_alignment(spark, radix_bits):
    data = token_rows()
    docs = documents(spark, data).repartition(3)
    want, count = aligned(data)
    got = token_alignment.align_tokens(docs, radix_bits=radix_bits)
    assert Counter(tuple(r) for r in got.collect()) == want
    if not radix_bits:
        best = {}
        for (b, a), n in count.items():
            best.setdefault(b, Counter())[a] = n
        rows = token_alignment.token_map(token_alignment.encode_links(docs)).collect()
        assert {(r["b"], r["a"], r["links"]) for r in rows} == {
            (b, a, n) for b, c in best.items() for a, n in c.items() if n == max(c.values())}


def test_runs_are_merged_exactly(monkeypatch):
    monkeypatch.setattr(token_alignment, "FRAME_RECORDS", 5)
    rng = np.random.default_rng(3)
    total, runs = Counter(), []
    for size in (0, 1, 4, 40, 500, 500):
        spill = token_alignment._Spill(0)
        pair = rng.integers(0, 30, size) << 16 | rng.integers(0, 4, size)
        doc = rng.integers(0, 50, size)
        total.update(pair.tolist())
        spill.add(pair, doc)
        for _, frames in spill.runs():
            runs.append(frames)
            read = [token_alignment.read_frame(f) for f in frames]
            keys = np.concatenate([r[0] for r in read])
            assert (np.diff(keys) >= 0).all() and sum(r[2].sum() for r in read) == size
            # no pair in two frames
            assert len(set(keys.tolist())) == sum(len(set(r[0].tolist())) for r in read)
    assert max(map(len, runs)) > 5
    out = [(int(p), int(n)) for pairs, links in token_alignment.merge_counts(runs) for p, n in zip(pairs, links)]
    assert out == sorted(total.items())


def test_alignment_clashing_columns(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, [(1, "one two", "x"), (1, "one two", "x"), (None, "one two", "x")])
    for name in ("spill", "doc", "radix", "frames", "n_a", "__text"):
        docs = docs.withColumn(name, F.lit("clash"))
    rows = token_alignment.align_tokens(docs).collect()
    assert len(rows) == 3 and len({tuple(r)[1:] for r in rows}) == 1 and rows[0]["n_links"] > 0
