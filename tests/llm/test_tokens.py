"""Piece codec and record files: exact round trips against the tokenizer libraries."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cases import ROWS, documents, empty
from conftest import SF_SMALL
from hearthlake.llm import records
from hearthlake.llm.piece_codec import encode_decode, model
from hearthlake.llm.queries import PIECE_MODEL, WORD_MODEL, registry

BITS = [" ", "  ", "   ", "\n", "\t", "a", "b", "the", "é", "▁", "漢", "🙂", "́", "ing", "_", "0", "12", "<s>", "</s>",
        "<0x41>", " ", "\r\n", "Ω", "!!!!", "\x00", "가", "don't", "ß", "<|endoftext|>", "\u0085", "\x0b", "\x1c"]


def strings(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def test_pieces_equal_the_library():
    codec, sp = model(PIECE_MODEL), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = strings(3000, 1) + [" " * k + w for k in range(40) for w in ("", "a", "é", "漢", "\n")] + ["a" * 5000, " " * 3000]
    for t in texts:
        ids = codec.encode(t)
        assert ids == sp.encode(t), t
        assert codec.decode(ids + [codec.end_id]) == sp.decode(ids + [sp.eos_id()]), t


def test_decoding_any_ids_equals_the_library():
    codec, sp, rng = model(PIECE_MODEL), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL), random.Random(2)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(1, 32000), rng.randrange(131, 259), 13]) for _ in range(rng.randint(0, 10))]
        assert codec.decode(ids) == sp.decode(ids), ids


def test_every_cut_of_a_word_is_checked():
    codec = model(PIECE_MODEL)
    for word in ("internationalization", "aaaaaaaaaa", "thethethe", "éàüß"):
        assert [codec.pieces[i] for i in codec.backtrack(word)] == codec.merge(word)


def test_encoded_rows(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    got = encode_decode(documents(spark), PIECE_MODEL)
    assert got.columns == [*documents(spark).columns, "piece_ids", "decoded_text"]
    for r, (i, t) in zip(got.collect(), ROWS, strict=True):
        assert r.doc_id == i and r.piece_ids == sp.encode(t or "") + [2] and r.decoded_text == sp.decode(r.piece_ids)
    assert encode_decode(empty(spark), PIECE_MODEL).collect() == []
    twice = encode_decode(got, PIECE_MODEL)  # the output columns replace columns of the same names
    assert twice.columns == got.columns and twice.collect() == got.collect()


def test_piece_query(spark):
    import hashlib
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = registry()["op4_piece_codec"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = sp.encode(texts[r.doc_id]) + [2]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())


def test_words_encode_as_whole_texts():
    tok, own = Tokenizer.from_file(WORD_MODEL), records.WordEncoder(WORD_MODEL, 2)
    texts = strings(3000, 3) + ["İstanbul don't it's abc,. abc'' x'sy é́ ǅungla '", "one İ two.", ""]
    for t, packed in zip(texts, own.encode(pa.array(texts), b""), strict=True):
        assert np.frombuffer(packed, "<u2").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def expected(rows):
    tok, start, out = Tokenizer.from_file(WORD_MODEL), 0, []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_record_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = registry()["op10_records"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == expected([(r.doc_id, r.text) for r in rows])


@pytest.mark.parametrize("files", [1, 4])
def test_records_with_awkward_rows(spark, files):
    docs = documents(spark)
    folder = records.records_folder(docs)
    index = records.write_records(docs, folder, WORD_MODEL, files=files)
    got = records.read_records(index, folder).collect()
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))
    position = 0
    for r in order:
        assert r.start == position and len(r.tokens) == 4 * r.n_tokens
        position += r.n_tokens
    tok = Tokenizer.from_file(WORD_MODEL)
    want = sorted(np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes() for _, t in ROWS)
    assert sorted(bytes(r.tokens) for r in got) == want
    shuffled = records.read_records(index.orderBy("n_tokens"), folder).collect()
    assert sorted(bytes(r.tokens) for r in shuffled) == want
    none = records.write_records(empty(spark), records.records_folder(docs), WORD_MODEL)
    assert none.collect() == []


def test_an_id_with_many_rows_fills_several_files(spark):
    docs = documents(spark, [(5, f"text {i}") for i in range(200)] + [(i, "x") for i in range(5)])
    folder = records.records_folder(docs)
    index = records.write_records(docs, folder, WORD_MODEL, files=8)
    assert index.filter("doc_id = 5").select("file").distinct().count() > 2
    got = sorted(records.read_records(index, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got) and len(got) == 205


def test_equal_rows_fill_several_files(spark):
    docs = documents(spark, [(5, "same text")] * 300 + [(i, "x") for i in range(9)])
    folder = records.records_folder(docs)
    index = records.write_records(docs, folder, WORD_MODEL, files=6)
    assert index.filter("doc_id = 5").select("file").distinct().count() > 2
    got = sorted(records.read_records(index, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got) and len(got) == 309
    assert [r.start for r in got[1:]] == [r.start + r.n_tokens for r in got[:-1]]


def test_starts_over_several_blocks_of_files(spark, monkeypatch):
    monkeypatch.setattr(records, "BLOCK_FILES", 2)
    rows = [(i, f"text {i} " * (i % 4)) for i in range(60)]
    docs = documents(spark, rows)
    folder = records.records_folder(docs)
    index = records.write_records(docs, folder, WORD_MODEL, files=7)
    assert index.select("file").distinct().count() > 4
    got = records.read_records(index, folder).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.tokens))) for r in got) == expected(rows)


class NoReplacing:
    """A file system whose rename refuses a name that is taken."""

    def __init__(self, fs):
        self.fs = fs

    def move(self, made, name):
        if self.fs.get_file_info(name).type != pafs.FileType.NotFound:
            raise OSError("file exists")
        self.fs.move(made, name)

    def __getattr__(self, name):
        return getattr(self.fs, name)


@pytest.mark.parametrize("wrap", [lambda fs: fs, NoReplacing])
def test_a_second_attempt_replaces_the_file(tmp_path, wrap):
    fs = wrap(pafs.LocalFileSystem())
    made, name = str(tmp_path / ".part-1"), str(tmp_path / "part")
    for data in (b"first attempt", b"second attempt"):
        (tmp_path / ".part-1").write_bytes(data)
        records.put_in_place(fs, made, name)
        assert (tmp_path / "part").read_bytes() == data and not (tmp_path / ".part-1").exists()
    with pytest.raises(OSError):
        records.put_in_place(fs, made, str(tmp_path / "missing"))


def test_damage_is_found(spark):
    record = records.frame(b"payload")
    assert records.unframe(record) == b"payload"
    for at in range(len(record)):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(broken))
    docs = documents(spark)
    folder = records.records_folder(docs)
    index = records.write_records(docs, folder, WORD_MODEL, files=1)
    fs, root = pafs.FileSystem.from_uri(folder)
    path = f"{root}/{index.first().file}"
    data = bytearray(fs.open_input_file(path).read())
    data[-6] ^= 1
    with fs.open_output_stream(path) as out:
        out.write(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        records.read_records(index, folder).collect()


def test_neighbours_are_judged_without_merging_them(monkeypatch):
    codec, sp, rng = model(PIECE_MODEL), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL), random.Random(5)
    made = sorted(codec.size)
    short = [i for i in made if len(codec.pieces[i]) <= 3]
    ids = {p: codec.ids[p] for p in ("oll", "ll", "ír", "rr", "ós", "ssl", "onen", "enen", "▁ll") if p in codec.ids}
    pairs = [(a, b) for a in ids.values() for b in ids.values()]
    pairs += [(rng.choice(some), rng.choice(some)) for some in (made, short) for _ in range(20_000)]
    for a, b in pairs:
        left, right = codec.pieces[a], codec.pieces[b]
        if not right.startswith("▁"):  # a chunk has its space marker in front
            assert codec.kept_apart(a, b) == (codec.merge(left + right) == [left, right]), (left, right)
    for kept in (codec.pairs, codec.cache, codec.older):
        kept.clear()
    text = " ".join("".join(rng.choice("aeilnorst") for _ in range(rng.randint(1, 14))) for _ in range(2000))
    monkeypatch.setattr(codec, "merge", None)
    assert codec.encode(text) == sp.encode(text)
