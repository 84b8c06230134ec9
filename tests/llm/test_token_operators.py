"""BPE coding, packing and token files against the tokenizers library and plain Python."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from parcelflow.llm import bpe, packing, token_files, tokens

BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))

TEXTS = [
    None, "", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "a\t b\r\n c", "aaaaaaaaaaa", "ha" * 3_000, "a\n", "\nA b", "\n a",
    "<|endoftext|>", "x <|endoftext|> y<|endoftext|>", "a <|startoftext|>b", "<|endof text|>", "don't we'll  I'M", "a,b. c, d.",
    "été 日本語 ½ Ⅷ ² x", "\x00a b\x1cc", "a b 　c", "😀😀 a😀", "ΑΣ ΟΔΟΣ Σ", "é é x", "İstanbul ﬁ", "ab\nΣ. x,",
    "The quick brown fox, jumps over. The lazy dog\nand again the quick brown foxes.",
]


def library(path, text):
    ids = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes()


def split(found):
    ids, bounds = found
    return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


@pytest.mark.parametrize(
    "encode, path",
    [
        (bpe.PairIndexBpe(BYTES).encode, BYTES),
        (tokens.ByteLevelEncoder(BYTES).encode, BYTES),
        (tokens.WordEncoder(WORDS).encode, WORDS),
    ],
    ids=["pair index", "byte level", "words"],
)
def test_ids_are_those_of_the_library(encode, path):
    expected = [library(path, t) for t in TEXTS]
    assert split(encode(pa.array(TEXTS, pa.string()))) == expected
    # once more with everything known, and each text by itself
    assert [split(encode(pa.array([t], pa.string())))[0] for t in TEXTS] == expected
    assert split(encode(pa.array([], pa.string()))) == []


def test_a_worker_forgets_long_pieces_and_stays_right(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 6)
    encoder = tokens.ByteLevelEncoder(BYTES)
    for text in ("one two three fourteenthly", "one two overwhelmingly", "five six seven eight nine ten", "one six"):
        assert split(encoder.encode(pa.array([text]))) == [library(BYTES, text)]


@pytest.fixture
def docs(spark):
    """Texts with every corner case, repeated rows, and a column that clashes with those the operators make."""
    rows = [(i, t, "x", 7) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x", 7), (None, "no id", "x", 7)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, length int").repartition(3)


def test_encode_decode(docs):
    rows = bpe.encode_decode(docs, BYTES).collect()
    assert len(rows) == docs.count()
    texts = dict(enumerate(TEXTS)) | {None: "no id"}
    for row in rows:
        assert bytes(row["ids"]) == library(BYTES, texts[row["doc_id"]])
        assert row["decoded"] == (texts[row["doc_id"]] or "")
    assert bpe.encode_decode(docs.limit(0), BYTES).count() == 0


def test_decoding_replaces_bytes_that_are_not_text():
    own = bpe.PairIndexBpe(BYTES)
    half = np.frombuffer(library(BYTES, "😀"), "<u4")[:1]
    assert own.decode(half) == Tokenizer.from_file(BYTES).decode(half.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("capacity", [1024, 16])
def test_packing_places_every_id_once(spark, docs, capacity, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    rows = packing.pack(docs, BYTES, capacity=capacity, with_ids=True).collect()
    texts = dict(enumerate(TEXTS)) | {None: "no id"}
    expected = sorted(
        (str(d), i, x)
        for d in [r["doc_id"] for r in docs.collect()]
        for i, x in enumerate([*np.frombuffer(library(BYTES, texts[d]), "<u4").tolist(), 0])
    )
    assert sorted((str(r["doc_id"]), r["start"] + i, x) for r in rows for i, x in enumerate(r["ids"])) == expected
    bins = {}
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        assert r["doc_tokens"] == len(library(BYTES, texts[r["doc_id"]])) // 4 + 1
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    # all bins but the last few are nearly full
    assert sum(capacity - sum(n for _, n in b) for b in bins.values()) <= 2 * capacity


def test_sequences_are_padded_unless_a_power_of_two(spark, docs):
    pieces = packing.pack(docs, BYTES, capacity=16, with_ids=True)
    for row in packing.sequences(pieces, capacity=16, pad_id=9).collect():
        n = row["length"]
        assert len(row["ids"]) == (n if n & (n - 1) == 0 else 16)
        assert row["ids"][n:] == [9] * (len(row["ids"]) - n)
    assert packing.pack(docs.limit(0), BYTES).count() == 0


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, docs, tmp_path, encoding):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(docs, WORDS, folder, encoding=encoding)
    texts = sorted(
        [(-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in docs.collect()]
    )
    start, expected = 0, []
    for doc, text in texts:
        ids = library(WORDS, text) + np.array([2], "<u4").tobytes()
        expected.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    found = [(-1 if r[0] is None else r[0], *r[1:]) for r in token_files.checksums(spark, folder).collect()]
    assert sorted(found) == sorted(expected)
    metadata = token_files.read_metadata(spark, folder)
    assert sorted((-1 if r[0] is None else r[0], r[1], r[2]) for r in metadata.collect()) == sorted(e[:3] for e in expected)
    assert {r["doc_id"]: len(r["ids"]) for r in token_files.read_tokens(spark, folder, [4, 5]).collect()} == {4: 2, 5: 2}
    plan = token_files.read_tokens(spark, folder, [4])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id, [4])" in plan or "EqualTo(doc_id,4)" in plan


@pytest.mark.parametrize("encoding, wanted", [("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_token_files_are_laid_out_for_selective_reads(spark, tmp_path, monkeypatch, encoding, wanted):
    """Encoding of the ids, several row groups, and a page index with more pages than row groups."""
    monkeypatch.setattr(token_files, "ROW_GROUP_BYTES", 2**16)
    monkeypatch.setattr(token_files, "PAGE_ROWS", 100)
    texts = spark.range(4_000).selectExpr("id AS doc_id", "repeat(concat('word', id % 977, ' other', id, ' '), 20) AS text")
    token_files.write_tokens(texts, WORDS, str(tmp_path / "t"), encoding=encoding)
    groups = 0
    for file in (tmp_path / "t").glob("*.parquet"):
        metadata = pq.ParquetFile(file).metadata
        groups += metadata.num_row_groups
        for g in range(metadata.num_row_groups):
            column = next(c for c in map(metadata.row_group(g).column, range(metadata.num_columns)) if c.path_in_schema.startswith("ids"))
            assert wanted in column.encodings or ("PLAIN_DICTIONARY" in column.encodings and encoding == "dictionary"), column.encodings
            assert column.has_offset_index and column.has_column_index
    assert groups > 1


def test_token_files_of_no_documents(spark, docs, tmp_path):
    folder = str(tmp_path / "none")
    token_files.write_tokens(docs.limit(0), WORDS, folder)
    assert token_files.checksums(spark, folder).count() == 0
    with pytest.raises(ValueError):
        token_files.write_tokens(docs, WORDS, folder, encoding="plain")
