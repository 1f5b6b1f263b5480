"""Language kernels, token alignment and phrase mining."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from tests.llm.corpus import SCHEMA, docs, empty, odd, words
from tripmill.llm import common, language_kernel, phrase_mining, token_alignment
from tripmill.llm.twins import ORACLE

FIRST, SECOND = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def _ngrams(text):
    found = set()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        found |= set(word) | {padded[i : i + 2] for i in range(len(padded) - 1)} | {padded[i : i + 3] for i in range(len(word))}
    return found


def test_kernel_counts_shared_ngrams():
    texts = ["The cat sat", "a cat, A HAT!", "niño está aquí 42", "zzz", "Ünder übt"]
    presence, lettered = language_kernel.presences([*texts, None, "", "42 -- !"])
    assert lettered.tolist() == [True] * 5 + [False] * 3
    sets = [_ngrams(t) for t in texts]
    want = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets] for a in sets]
    assert np.allclose(language_kernel.kernel(presence[:5], presence[:5]), want, atol=1e-6)


def test_scores_are_the_landmark_kernel_times_the_weights():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdef" if i % 2 else "cdefgh") for _ in range(5)) for _ in range(8)) for i in range(60)]
    langs = ["x" if i % 2 else "y" for i in range(60)]
    presence, _ = language_kernel.presences(texts)
    model = language_kernel.fit_kernel(np.packbits(presence.astype(bool), axis=1), langs, landmarks=60, penalty=1e-2)
    # without a low rank, ridge regression on all landmarks is kernel ridge regression
    k = language_kernel.kernel(presence, presence).astype(float)
    target = np.array([[x == "x", x == "y"] for x in langs]) - 0.5
    want = k @ np.linalg.solve(k + 1e-2 * 60 * np.eye(60), target)
    assert np.allclose(model.values(presence), want, atol=2e-3)


def test_long_text_is_read_in_parts(monkeypatch):
    text = " ".join(words(3_000, 5)) + "é" * 50
    whole, _ = language_kernel.presences([text, "b a", text[::-1]])
    monkeypatch.setattr(language_kernel, "PART_CHARS", 100)
    parts, _ = language_kernel.presences([text, "b a", text[::-1]])
    assert (whole == parts).all()


def _labelled(spark, n=400):
    rng = random.Random(8)
    syllables = {"aa": ["ka", "to", "mi", "ra"], "bb": ["schl", "ung", "ein", "cht"], "cc": ["ção", "nh", "lha", "ez"]}
    rows = []
    for i in range(n):
        lang = rng.choice(["aa", "aa", "aa", "aa", "bb", "cc"])
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 30)))
        rows.append((i, text, lang, "s", len(text), 0))
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_held_out_languages_are_told_apart(spark):
    rows, df = _labelled(spark)
    got = {r.doc_id: r for r in language_kernel.languages(df).collect()}
    assert len(got) == len(rows) and 50 < sum(r.held_out for r in got.values()) < 150
    assert all(got[i].lang_pred == lang and 0.5 < got[i].score <= 1 for i, _, lang, *_ in rows)


def test_language_of_held_out_rows_is_no_input(spark):
    rows, df = _labelled(spark, 150)
    held = {r.doc_id for r in language_kernel.languages(df).filter("held_out").collect()}
    other = spark.createDataFrame([(i, t, "zz" if i in held else lang, *rest) for i, t, lang, *rest in rows], SCHEMA)
    a, b = (sorted(tuple(r) for r in language_kernel.languages(x).collect()) for x in (df, other))
    assert a == b


def test_language_of_odd_rows(spark):
    got = language_kernel.languages(odd(spark).selectExpr("*", "doc_id as score", "lang as lang_pred")).collect()
    assert len(got) == 7 and {r.lang_pred for r in got} <= {"en", "tr", "und"}
    assert all((r.lang_pred == "und") == (r.doc_id in (0, 1)) and (r.score == 0) == (r.lang_pred == "und") for r in got)
    assert language_kernel.languages(empty(spark)).collect() == []
    unlabelled = spark.createDataFrame([(1, "words", None, "a", 0, 0)], SCHEMA)
    assert [tuple(r)[2:] for r in language_kernel.languages(unlabelled).collect()] == [("und", 0.0)]


@pytest.mark.parametrize("run", [1, 5, 64])
def test_gallop_finds_every_place(monkeypatch, run):
    monkeypatch.setattr(token_alignment, "RUN", run)
    rng = np.random.default_rng(run)
    for size, top in ((0, 5), (1, 5), (40, 60), (300, 100_000)):
        a, b = (np.unique(rng.integers(1, top, size)) for _ in range(2))
        assert token_alignment.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def _alignment(texts):
    """Links by comparing every pair of tokens' byte ranges, with another byte-level tokenizer of the same vocabulary."""
    import base64

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    first = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    bytes_of = {i: b for b, i in ranks.items()}
    rows, held = [], Counter()
    for text in texts:
        raw = b" " + (text or "").encode()
        a = [(i, bytes_of[i]) for i in (first.encode_ordinary(" " + text) if text else [])]
        b = []
        for i in second.encode(text) if text else []:
            piece = second.id_to_piece(i)
            b.append((i, bytes.fromhex(piece[3:5]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            rows.append(None)
            continue
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, x in side:
                own.append((i, at, at + len(x)))
                at += len(x)
            spans.append(own)
        links = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e]
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < cut) for side in spans))
            low = cut
        rows.append((len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        held.update(set(links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    none = (0, 0, 0, 0, 0, 0, "")
    return [
        none if r is None else (*r[:3], len(r[3]), sum(held[x] == best[x[0]] for x in r[3]), sum(held[x] for x in r[3]), r[4])
        for r in rows
    ]


def _texts():
    rng = random.Random(2)
    letters = "abcdefghij  .,ñéßüあ\U0001f600́\n\t0123'<>|"
    fuzz = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    plain = [" ".join(words(rng.randint(1, 60), 70 + i)) for i in range(40)]
    fixed = [None, "", " ", "a", " lead", "two  spaces", "trail ", "▁x", "<|endoftext|> <s></s><unk>", "<0x41>", "ﬁ ligature", "\r\n"]
    return [*fixed, *plain, *plain[:5], *fuzz]


def test_alignment_equals_comparing_all_pairs(spark):
    texts = _texts()
    want = _alignment(texts)
    assert sum(w[0] == 0 for w in want) == 3
    for block, size in ((1_000_000, 2 << 20), (500, 300)):
        got = token_alignment.alignment(docs(spark, texts).repartition(3), FIRST, SECOND, block, size).collect()
        assert [tuple(r)[1:] for r in sorted(got, key=lambda r: r.doc_id)] == want


def test_stretches_are_encoded_as_within_their_text():
    """No token of either tokenizer reaches across a cut."""
    coder, rng = token_alignment._Coder(FIRST, SECOND), random.Random(9)
    assert [token_alignment._stretches(pa.array(["a b", "", "c  d é f"]))[0].to_pylist()] == [[" a", " b", " ", " c  d", " é", " f"]]
    letters = "aZ19.,'!_-éßÿ\u0100ɏɐ\u0301あ\U0001f600\u00a0\u2003\u0085\n\t       "
    for _ in range(3_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 25)))
        flat, _ = token_alignment._stretches(pa.array([text]))
        whole, parts = coder.encode([" " + text]), coder.encode(flat.to_pylist())
        for side in (0, 1):
            assert whole[side][0].tolist() == parts[side][0].tolist(), repr(text)


def test_links_of_a_block_are_packed():
    for values in ([], [0], [5], [0, 0, 0, 300, 300, 70_000, 1 << 33], list(range(0, 3_000, 3))):
        packed = token_alignment._packed(np.array(values, np.int64))
        assert token_alignment._unpacked(packed, len(values)).tolist() == values
    memo = token_alignment._memo(FIRST, SECOND)
    made = token_alignment.align(memo, pa.array([" ".join(words(2_000, 300 + i)) for i in range(10)]))
    block = token_alignment._block(0, list(range(10)), [made])
    links = block.column("links").nbytes
    assert len(made.links) > 50_000 and links < 3 * len(made.links)


def test_alignment_holds_few_blocks_at_a_time(spark, tmp_path, monkeypatch):
    """Readers hold a row group's blocks at once; all of a task's are one if the writer does not look at their size."""
    monkeypatch.setattr(common, "scratch_dir", lambda spark, label: str(tmp_path / label))
    monkeypatch.setitem(token_alignment._ROW_GROUPS, "parquet.block.size", 50_000)
    texts = [" ".join(words(1_000, 400 + i)) for i in range(40)]
    got = token_alignment.alignment(docs(spark, texts).coalesce(1), FIRST, SECOND, 5_000, 5_000).collect()
    assert len(got) == 40
    (file,) = tmp_path.glob("align-blocks/*.parquet")
    found = pq.ParquetFile(file).metadata
    assert found.num_rows == 20 and found.num_row_groups >= 4


def test_blocks_of_empty_texts_end(spark, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    frame = docs(spark, [""] * 50).coalesce(1)
    sizes = [len(r.doc_ids) for r in token_alignment._blocks(frame, FIRST, SECOND, 20, 10).collect()]
    assert sum(sizes) == 50 and max(sizes) == 20


def test_scoring_drops_what_aligning_kept():
    memo = token_alignment._memo(FIRST, SECOND)
    made = token_alignment.align(memo, pa.array(["some words", "", "words"]))
    own = token_alignment._block(0, [1, None, 3], [made]).to_pandas()
    answers = pd.DataFrame({"pair": own["pairs"][0], "n": 1, "best": True})
    out = token_alignment._score(own, answers)
    assert out["n_best"].tolist() == out["count_sum"].tolist() == out["n_links"].tolist() and not token_alignment._memos


def test_alignment_of_odd_rows(spark):
    frame = odd(spark).selectExpr("*", "doc_id as block", "doc_id as pair")
    got = token_alignment.alignment(frame, FIRST, SECOND).collect()
    assert len(got) == 7 and sum(r.doc_id is None for r in got) == 1
    by_id = {r.doc_id: r for r in got}
    assert tuple(by_id[0])[1:] == tuple(by_id[1])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert by_id[3].n_a > 30_000 and by_id[None].n_links > 0
    assert token_alignment.alignment(empty(spark), FIRST, SECOND).collect() == []


def _collocations(rows, support, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und"] += len(ws)
            for k in range(1, 6):
                counts[lang or "und"].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, own in counts.items():
        frequent = {p: a for p, a in own.items() if len(p) > 1 and a >= support}
        scored = []
        for p, a in frequent.items():
            inside = (o for o in frequent if len(o) > len(p) and any(o[i : i + len(p)] == p for i in range(len(o) - len(p) + 1)))
            if any(frequent[o] >= a for o in inside):
                continue
            cuts = [(1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def _phrases():
    rng = random.Random(6)
    common = ["of the", "new York city", "Été à Paris", "a a a", "x y z u v w"]
    rows = []
    for i in range(300):
        parts = [rng.choice([*common, *words(1, rng.randrange(40)), "the", ".", "\n", ",", "\t"]) for _ in range(rng.randint(0, 40))]
        rows.append((" ".join(parts), rng.choice(["en", "en", "fr", None])))
    return [*rows, (None, "en"), ("", "en"), ("THE end", "xx"), ("only", "xx")]


@pytest.mark.parametrize("one_in, lowered, bits", [(1, 1.0, 1 << 20), (4, 0.6, 1 << 20), (4, 9.0, 1 << 20), (3, 2.0, 1 << 12), (50, 60.0, 1 << 26)])
def test_phrases_equal_brute_force_whatever_the_sample_proposes(spark, one_in, lowered, bits):
    rows = _phrases()
    frame = spark.createDataFrame([(i, t, lang, "s", 0, 0) for i, (t, lang) in enumerate(rows)], SCHEMA)
    got = phrase_mining.collocations(frame, 12, 25, one_in=one_in, lowered=lowered, bits=bits).collect()
    want = _collocations(rows, 12, 25)
    assert sorted(tuple(r) for r in got) == want and len(want) > 30


def test_one_expansion_pass_closes_the_border(spark, monkeypatch):
    """With nothing proposed, all words fail, and the expansion counts whatever they make."""
    passes = []
    counts = phrase_mining._key_counts
    monkeypatch.setattr(phrase_mining, "_key_counts", lambda *a: passes.append(a[2] is not None) or counts(*a))
    frame = docs(spark, ["a b c d e f"] * 30)
    got = phrase_mining.phrase_counts(frame, 20, one_in=4, lowered=100.0, bits=1 << 20).collect()
    assert sum(passes) == 1 and {r.phrase: r.n for r in got if r["size"] == 5} == {"a b c d e": 30, "b c d e f": 30}


def test_ranks_by_groups_equal_one_window(spark, monkeypatch):
    frame = docs(spark, [" ".join(words(200, i % 7)) for i in range(60)])
    whole = phrase_mining.collocations(frame, 5, 20).collect()
    monkeypatch.setattr(phrase_mining, "RANKED_ROWS", 40)
    assert phrase_mining.collocations(frame, 5, 20).collect() == whole and len(whole) == 20


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_007
    frequent = spark.createDataFrame(
        [("e", "a b", 2, big), ("e", "a", 1, big + 11), ("e", "b", 1, big + 5)], "lang string, phrase string, size int, n long"
    )
    totals = spark.createDataFrame([("e", 10 * big)], "lang string, n long")
    row = phrase_mining._cuts(frequent.filter("size > 1"), frequent, totals).first()
    assert row.score == 1000 * big * 10 * big // ((big + 11) * (big + 5))


def test_phrases_of_odd_rows(spark):
    frame = odd(spark).selectExpr("*", "doc_id as n", "text as phrase")
    got = phrase_mining.collocations(frame, 2).collect()
    assert ("en", "same row twice with a") in {(r.lang, r.phrase) for r in got}
    assert all(r.rank >= 1 and r.a >= 2 for r in got)
    assert sorted(phrase_mining.collocations(frame, 2, slice_bytes=50).collect()) == sorted(got)
    assert phrase_mining.collocations(empty(spark)).collect() == []
    assert "op13_phrase_mining" in ORACLE


def test_a_task_gives_a_phrase_once(spark, monkeypatch):
    """However many slices it reads, and the same counts when it holds few rows at a time."""
    frame = docs(spark, ["some words stand here, and some words stand there"] * 60).select(F.lit("en").alias("lang"), "text")
    every = np.full(1 << 10, 255, np.uint8)
    made, group = [], type(frame).groupBy
    monkeypatch.setattr(type(frame), "groupBy", lambda self, *by: made.append(self) or group(self, *by))
    counted = phrase_mining._phrase_counts(frame.repartition(1), every, 100)
    rows = sorted(made[0].collect())
    assert len(rows) == len({(r.lang, r.phrase) for r in rows})
    assert {r.phrase: r.n for r in rows if r["size"] in (0, 3)} == {
        "": 540, "some words stand": 120, "words stand here": 60, "and some words": 60, "words stand there": 60
    }
    assert sorted(counted.collect()) == rows
    monkeypatch.setattr(phrase_mining, "MERGED_ROWS", 3)
    monkeypatch.setattr(phrase_mining, "HELD_ROWS", 5)
    assert sorted(phrase_mining._phrase_counts(frame.repartition(1), every, 100).collect()) == rows
    assert len(made[1].collect()) > len(rows)


def test_a_task_gives_a_key_once(spark, monkeypatch):
    """Its slices are added up before the shuffle, and the counts are the same when it holds few keys at a time."""
    frame = docs(spark, ["some words stand here, and some words stand there"] * 60).select(F.lit("en").alias("lang"), "text")
    every = np.full(1 << 10, 255, np.uint8)
    made, group = [], type(frame).groupBy
    monkeypatch.setattr(type(frame), "groupBy", lambda self, *by: made.append(self) or group(self, *by))

    def counted():
        return phrase_mining._key_counts(frame.repartition(1), every, None, range(1, 6), 100)

    rows = sorted((r.key, r.n) for r in counted().collect())
    # 6 words; 5, 4, 3 and 1 phrases of 2 to 5 words
    assert sorted(n for _, n in rows) == [60] * 13 + [120] * 6
    assert sorted((r.key, r.n) for r in made[0].collect()) == rows
    monkeypatch.setattr(phrase_mining, "HELD_KEYS", 5)
    assert sorted((r.key, r.n) for r in counted().collect()) == rows
    assert len(made[1].collect()) > len(rows)
