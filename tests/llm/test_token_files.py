"""Elias-Fano sequences and token files against the tokenizers library and plain sums."""

import random
import zlib

import numpy as np
import pytest
from llm_tables import SCHEMA, as_docs, no_docs, odd, odd_docs  # noqa: F401 - fixtures

from fleetlake.llm import token_files
from fleetlake.llm.elias_fano import EliasFano
from fleetlake.llm.queries import vocabulary

VOCABULARY = vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(VOCABULARY)
    made.no_truncation()
    made.no_padding()
    return lambda text: made.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("values", [
    [], [0], [2**64 - 1], [0, 0, 0], [0, 2**64 - 1], [5] * 1000, list(range(5000)), [0, 1, 10**6, 10**6, 10**6 + 1],
    [2**63 - 1, 2**63, 2**63 + 1]])
def test_elias_fano_cases(values):
    made = EliasFano(EliasFano.encode(np.array(values, dtype=np.uint64)))
    assert made.n == len(values)
    assert made.get(np.arange(len(values))).tolist() == values


@pytest.mark.parametrize("seed", range(8))
def test_elias_fano_any_places(seed):
    rng = np.random.default_rng(seed)
    top = 2 ** rng.integers(1, 63)
    values = np.sort(rng.integers(0, top, rng.integers(1, 20_000), dtype=np.uint64))
    data = EliasFano.encode(values)
    made = EliasFano(data)
    places = rng.integers(0, len(values), 500)
    assert (made.get(places) == values[places]).all()
    # low bits, two bits of the high part, the counts and a rounded block
    assert 8 * len(data) < len(values) * (made.low_bits + 4.5) + 2000


def test_no_table_of_offsets():
    """Boundaries of 100,000 documents of about 700 ids take under 13 bits each."""
    rng = np.random.default_rng(1)
    bounds = np.cumsum(rng.integers(1, 1400, 100_000))
    assert 8 * len(EliasFano.encode(bounds)) < 13 * len(bounds)


TEXTS = [
    "", " ", "\n\n\n", "plain words, with 'll and 's; don't", "tab\tand\r\nreturn   no-break", "ÉTÉ à l'école — ñandú",
    "12 345.67 ½ ² Ⅷ", "漢字かな交じり文", "emoji \U0001f600\U0001f1eb\U0001f1f7", "\x1c\x1d\x85 line", "ﬁ ｆｕｌｌ",
    "a<|endoftext|>b <|endoftext|>", "  leading", "trailing   ", "y" * 5000, "=" * 300 + "\t" * 40 + "x", "Ελληνικά и русский"]


@pytest.mark.parametrize("text", TEXTS)
def test_encoder(library, text):
    tool = token_files.Encoder(VOCABULARY)
    assert np.frombuffer(tool.encode([text])[0], tool.kind).tolist() == library(text)


def test_encoder_many(library, monkeypatch):
    """Few remembered pieces, portions of a long text, random characters."""
    monkeypatch.setattr(token_files, "PIECES", 50)
    tool = token_files.Encoder(VOCABULARY)
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice(" \n\t'sltdreab.,;!12éß -") for _ in range(rng.randint(1, 200)))
        assert np.frombuffer(tool.encode([text])[0], tool.kind).tolist() == library(text)
    monkeypatch.setattr(token_files, "LONG_TEXT", 10)
    text = "some  words 'll be\n\n\n taken in portions " * 9000
    assert np.frombuffer(tool.encode([text])[0], tool.kind).tolist() == library(text)


def wanted(rows, library):
    """Rows in the order of the ids (equal ids in any order) → id, start, length, checksum."""
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library(text or "") + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def check(docs, rows, root, library, spark):
    manifest = token_files.write_token_files(docs, root, VOCABULARY)
    found = sorted(map(tuple, token_files.read_token_files(spark, root).collect()), key=lambda r: r[1])
    want = wanted(rows, library)
    assert [r[0] for r in found] == [r[0] for r in want]
    assert sorted((str(r[0]), *r[2:]) for r in found) == sorted((str(r[0]), *r[2:]) for r in want)
    assert [r[1] for r in found] == np.cumsum([0] + [r[2] for r in found])[:-1].tolist()
    return manifest


def test_odd_rows(spark, odd_docs, odd, no_docs, library, tmp_path):
    check(odd_docs, odd, str(tmp_path / "odd"), library, spark)
    assert token_files.write_token_files(no_docs, str(tmp_path / "none"), VOCABULARY).count() == 0
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_small_files(spark, library, tmp_path, monkeypatch):
    """A task's stretch in several files; a third of the rows on one id; negative and far ids."""
    rng = random.Random(4)
    rows = [(7 if i % 3 == 0 else rng.choice([-2**63, -5, i, 2**63 - 1 - i]), f"text {i} " * rng.randint(0, 9)) for i in range(300)]
    docs = as_docs(spark, rows)
    manifest = check(docs, rows, f"file:{tmp_path}/whole", library, spark)
    files = [token_files.TokenFile(r["path"]) for r in manifest.collect()]
    assert sum(f.n_docs for f in files) == 300
    one = max(files, key=lambda f: f.n_docs)
    bounds = one.bounds(np.arange(one.n_docs + 1))
    assert one.ids(0, one.n_ids)[bounds[1:] - 1].tolist() == [2] * one.n_docs  # every document ends with the end id


def test_equal_rows(spark, library, tmp_path):
    """A third of the rows are one row and as many the same without an id: their ids lie
    in order, and they are dealt to many tasks."""
    rng = random.Random(6)
    rows = [(7 if i % 3 == 0 else None, "a row of many copies") if i % 3 < 2 else (rng.randint(0, 14), f"text {i}")
            for i in range(3000)]
    manifest = check(as_docs(spark, rows), rows, str(tmp_path / "copies"), library, spark)
    sizes = [r["n_docs"] for r in manifest.collect()]
    assert sum(sizes) == 3000 and len(sizes) >= 12 and max(sizes) < 500


def test_writer_rolls_over(tmp_path, monkeypatch, library):
    monkeypatch.setattr(token_files, "FILE_DOCS", 3)
    made, out = [], None
    tool = token_files.Encoder(VOCABULARY)
    for i in range(8):
        out = out or token_files._Writer(str(tmp_path / "r"), 4, len(made), tool.kind)
        out.add(None if i < 2 else i, tool.encode([f"document {i}"])[0])
        if out.full():
            made.append(out.close())
            out = None
    made.append(out.close())
    assert [m[3] for m in made] == [3, 3, 2]
    files = [token_files.TokenFile(m[2]) for m in made]
    assert [i for f in files for i in f.doc_ids(np.arange(f.n_docs))] == [None, None, 2, 3, 4, 5, 6, 7]
    assert files[1].ids(0, int(files[1].bounds(np.array([1]))[0])).tolist() == library("document 3")
