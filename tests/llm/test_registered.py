"""The registered queries themselves on the smallest tables, their columns recomputed by the plain rules."""

import base64
import hashlib
import os
import re
import zlib
from math import log10

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as contract
from tests.llm.test_operators import classes, shingles

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def texts():
    rows = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    return {int(i): t or "" for i, t in zip(rows.doc_id, rows.text)}


def rows_of(spark, name):
    return {r.doc_id: r for r in contract.queries()[name](spark, SF).collect()}


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def remainder(doc_id: int, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n


def test_byte_bpe(spark, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows_of(spark, "op1_byte_bpe")
    assert set(got) == set(texts)
    for i, text in texts.items():
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(ids.tobytes()), sha(text.encode()))


def test_token_files_and_packing(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    got, start = rows_of(spark, "op2_token_files"), 0
    for i in sorted(texts):
        one = np.array([*ids[i], 1], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(one), zlib.crc32(one.tobytes()))
        start += len(one)
    held, total = {}, 0
    for r in contract.queries()["op12_packing"](spark, SF).collect():
        one = np.array([*ids[r.doc_id], 0], "<u4")[r.start:r.start + 2048]
        assert (r.start, r.length, r.ids_crc32) == (2048 * r.piece, len(one), zlib.crc32(one.tobytes()))
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total += r.length
    assert total == sum(len(x) + 1 for x in ids.values()) and len(held) <= -(-total // 2048) + 1
    for own in held.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048


def test_fingerprints(spark, texts):
    got, order = rows_of(spark, "op3_order_minhash"), sorted(texts)
    by_text = {}
    for i, following in zip(order, order[1:] + order[:1]):
        text, n = texts[i], len(texts[i]) // 4
        edited = text[:len(text) - n] + texts[following][:n]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), sha(edited.encode()))
        assert by_text.setdefault(text, got[i].fingerprint) == got[i].fingerprint
        assert by_text.setdefault(edited, got[i].edited_fingerprint) == got[i].edited_fingerprint
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()]) + 0.3


def test_secrets(spark, texts):
    kinds = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
             ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24))
    got = rows_of(spark, "op4_secrets")
    for i, text in texts.items():
        found = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, pattern, fine) in enumerate(kinds) for m in pattern.finditer(text) if fine(m)]
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(f[1] == k for f in found) for k in range(3))
        assert got[i].base_sha256 == sha(",".join(f[2] for f in sorted(found)).encode())
        assert {f[2] for f in found} <= set(got[i].spans.split(","))


def test_language_model(spark, texts):
    tokens = {i: WORD.findall(lowered(t)) + [None] for i, t in texts.items()}
    counts = {}
    for i, own in tokens.items():
        if remainder(i, 7) != 2:
            for token in own:
                counts[token] = counts.get(token, 0) + 1
    n, v = sum(counts.values()), len(counts)
    got = rows_of(spark, "op5_lm")
    for i, own in tokens.items():
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (remainder(i, 7) == 2, len(own), sum(t in counts for t in own), n)
        assert got[i].base_score == pytest.approx(sum(log10((counts.get(t, 0) + 1) / (n + v + 1)) for t in own)) and got[i].score <= 0


def test_license_phrases(spark, texts):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    got = rows_of(spark, "op7_licenses")
    for i, text in texts.items():
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        places = [(k, label) for phrase, label in phrases.items() for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
        at = [k for k, _ in places]
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word) == (len(words), len(at), min(at, default=None), max(at, default=None))
        assert got[i].base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, got[i].base_labels.split(","))) <= set(got[i].labels.split(",")) and 0 <= got[i].score <= 1
    assert any(r.n_base for r in got.values())


def test_quality_measures(spark, texts):
    got = rows_of(spark, "op8_weak_supervision")
    for i, text in texts.items():
        words = WORD.findall(text)
        windows = {}
        for k in range(len(words) - 2):
            windows.setdefault(tuple(words[k:k + 3]), []).append(k)
        repeated = {k + j for places in windows.values() if len(places) > 1 for k in places for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        row = got[i]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words)) and not (row.base_failed and row.kept)


def test_near_duplicates(spark, texts):
    want, got = classes(list(texts.items())), rows_of(spark, "op9_near_dups")
    for i, text in texts.items():
        assert (got[i].component_id, got[i].n_shingles, got[i].kept) == (want[i], len(shingles(text)), want[i] == i)


def test_language(spark, texts):
    rows = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").lang.to_dict()
    got = rows_of(spark, "op10_language")
    assert set(got) == set(texts) and all(r.held_out == (remainder(i, 4) == 2) and 0 <= r.score <= 1 for i, r in got.items())
    said = [(r.lang_pred, rows[i]) for i, r in got.items() if r.held_out and rows[i]]
    assert sum(a == b for a, b in said) >= 0.95 * len(said)


def test_pipeline(spark, texts):
    out = contract.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids"]
    rows = out.collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows) and {r.doc_id for r in rows} <= set(texts)
    near = classes(list(texts.items()), 80)
    left = [i for i in {r.doc_id for r in rows}]
    assert len({near[i] for i in left}) == len(left)  # one document of each class at most
