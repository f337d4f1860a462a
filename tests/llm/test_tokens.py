import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.data import no_documents, odd_documents, odd_rows
from threadlens.llm import token_counts, token_files

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
RANGES = [chr(c) * 2 + " a" + chr(c) + "\n" + chr(c) + "b" for c in [*range(0x260), *range(0x2000, 0x2070), 0x3A3, 0x130, 0x300, 0xAC00]]
SPACES = ["", " ", "\n", "a b\nc", " a", "a  b", "a\n\nb ", "x \ny", "x\n y", "it's I'LL 's 'S", "aaaa aaaaaaaaa", "10 007 ½²", "<|endoftext|>x"]


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}


def test_encoder_gives_the_library_ids(library):
    encode = token_files.text_encoder(BYTES)
    texts = RANGES + SPACES
    for _ in range(2):  # from the library, then from the table of known units
        expected = [e.ids for e in library[BYTES].encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == expected


def test_counter_gives_the_library_counts(library):
    count = token_counts.text_counter(WORDS)
    texts = RANGES + SPACES
    for _ in range(2):
        assert count(texts) == [len(e.ids) for e in library[WORDS].encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aab 'sé\n.\t1<|中"), max_size=40), min_size=1, max_size=5))
def test_any_text(texts):
    byte, word = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    assert [len(b) // 4 for b in token_files.text_encoder(BYTES)(texts)] == [
        len(e.ids) for e in byte.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.text_counter(WORDS)(texts) == [len(e.ids) for e in word.encode_batch(texts, add_special_tokens=False)]


def brute(library):
    rows = sorted(((r[0], r[1] or "") for r in odd_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for key, text in rows:
        ids = library[BYTES].encode(text, add_special_tokens=False).ids + [0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return Counter(out)


def test_files_round_trip(spark, library):
    found = token_files.token_files(odd_documents(spark), BYTES)
    assert Counter(tuple(r) for r in found.collect()) == brute(library)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_no_documents(spark):
    assert token_files.token_files(no_documents(spark), BYTES).collect() == []
    assert token_counts.count_tokens(no_documents(spark), WORDS).collect() == []


def test_single_documents_and_damage(tmp_path):
    path = str(tmp_path / "a.zst")
    writer = token_files.TokenFileWriter(path)
    bodies = [np.arange(n, dtype="<u4").tobytes() for n in (1, 5000, 3)]
    for key, body in zip([4, None, 9], bodies):
        writer.append(key, body)
    writer.close()
    source = token_files.TokenFile(path)
    assert [(p, b) for p, b in source.documents({9})] == [(2, bodies[2])]
    assert source.keys == [4, None, 9]
    # any decoder reads the whole file
    import zstandard

    with open(path, "rb") as file:
        data = file.read()
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == b"".join(bodies)
    # one damaged frame leaves the others readable
    at = int(source.offsets[1]) + 20
    with open(path, "r+b") as file:
        file.seek(at)
        file.write(bytes([data[at] ^ 255]))
    damaged = token_files.TokenFile(path)
    assert damaged.ids(0) == bodies[0] and damaged.ids(2) == bodies[2]
    with pytest.raises(Exception):
        damaged.ids(1)


def test_wanted_documents_only(spark, tmp_path):
    manifest = token_files.write_token_files(odd_documents(spark), str(tmp_path / "files"), BYTES)
    found = token_files.read_token_files(manifest, [3, 9], with_ids=True).collect()
    assert sorted(r["doc_id"] for r in found) == [3, 9, 9, 9]
    assert all(len(r["ids"]) == r["n_tokens"] and r["ids"][-1] == 0 for r in found)


def test_token_counts_query(spark, library):
    found = token_counts.flag_long(token_counts.count_tokens(odd_documents(spark), WORDS), 2048)
    expected = Counter()
    for r in odd_rows():
        n = len(library[WORDS].encode(r[1] or "", add_special_tokens=False).ids)
        expected[r[0], len((r[1] or "").encode()), n, n > 2048] += 1
    assert Counter(tuple(r) for r in found.collect()) == expected
