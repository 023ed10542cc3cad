"""Packing, direct codes and counts against the libraries themselves."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidelake.llm import direct_codes, packing, transducer, word_codes

WORD, PIECE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


def random_texts(n, seed):
    chance = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz" * 3 + "ABCDEéèüßñÅ0123456789.,'\"!?-_#*$ \n\t  ▁€漢🙂<>/|"
    odd = ["", " ", "  a", "a ", "a\n\nb", "<|endoftext|>", "x<|ENDOFTEXT|>y", "İΣς", "é ́a", "a\x0bd\x0ce", "x" * 5000]
    odd += ["<s> </s> <0x0A>", "▁x", "don't I'LL we're", "FOO., bar.. BAZ,", "the " * 50 + " " * 40]
    return odd + ["".join(chance.choices(letters, k=chance.randint(1, 200))) for _ in range(n)]


def test_word_ids_are_the_librarys(library):
    texts = random_texts(2000, 1)
    ids, counts = word_codes.WordCodes(WORD).encode(pa.array(texts))
    at = 0
    for text, n in zip(texts, counts, strict=True):
        assert ids[at : at + n].tolist() == library.encode(text, add_special_tokens=False).ids, text
        at += n


def test_forgetting_changes_nothing():
    texts = pa.array(random_texts(300, 2))
    whole = word_codes.WordCodes(WORD).encode(texts)
    some = word_codes.WordCodes(WORD, remembered=10)
    some.encode(texts)
    again = some.encode(texts)
    assert all((a == b).all() for a, b in zip(whole, again, strict=True))


def test_other_vocabularies_are_refused():
    """Their tokens hold spaces, or tell cases apart, so a word's ids depend on what is beside it."""
    with pytest.raises(ValueError, match="spaces"):
        word_codes.WordCodes(public_tokenizers.path("byte_bpe_50k.json"))


def test_long_words_are_not_remembered(library, monkeypatch):
    chance = random.Random(14)
    codes = word_codes.WordCodes(WORD)
    texts = [" ".join(["".join(chance.choices("abcDE", k=9000)) + chance.choice([".", "", ","]) for _ in range(5)] + ["ab Cd."]) for _ in range(30)]
    for text in texts:
        ids, _ = codes.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, codes.place)) <= word_codes.LONGEST
    monkeypatch.setattr(word_codes, "REMEMBERED_BYTES", 10_000)
    for text in texts[:3]:
        assert codes.encode(pa.array([text]))[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(codes.place) < 30


def test_transducer_counts_are_the_librarys(monkeypatch):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    machine = transducer.Transducer(PIECE)
    chance = random.Random(3)
    pieces = list(machine.rank)
    texts = random_texts(3000, 4)
    texts += ["".join(chance.choices(pieces, k=20)).replace("▁", " ") for _ in range(3000)]
    expected = [len(x) for x in model.encode(texts)]
    assert machine.count_texts(pa.array(texts)).tolist() == expected
    monkeypatch.setattr(transducer, "REMEMBERED_STATES", 50)
    assert transducer.Transducer(PIECE).count_texts(pa.array(texts[:800])).tolist() == expected[:800]


def test_token_counts_of_awkward_rows(awkward, nothing):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    expected = collections.Counter(
        (r.doc_id, len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in awkward.collect()
    )
    assert collections.Counter(map(tuple, transducer.count_tokens(awkward, PIECE).collect())) == expected
    assert transducer.count_tokens(nothing, PIECE).collect() == []


def test_codes_go_round_and_give_any_token():
    chance = np.random.default_rng(5)
    for ids in ([], [0], [255, 256, 65535, 65536, 2**32 - 1], chance.integers(0, 49408, 3000), chance.integers(0, 9, 600)):
        ids = np.array(ids, np.uint32)
        chunks, bitmaps, ranks = direct_codes.encode_ids(ids)
        assert (direct_codes.decode_ids(chunks, bitmaps) == ids).all()
        for place in range(0, len(ids), 7):
            assert direct_codes.token_at(chunks, bitmaps, ranks, place) == ids[place]


def expected_codes(rows, library, end):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_direct_codes_of_awkward_rows(spark, clashing, nothing, library, folder):
    direct_codes.write(clashing, f"{folder}/a", WORD, files=3)
    got = sorted((tuple(r) for r in direct_codes.read_documents(spark, f"{folder}/a").collect()), key=str)
    assert got == expected_codes([(r.doc_id, r.text) for r in clashing.collect()], library, 1)
    direct_codes.write(nothing, f"{folder}/b", WORD)
    assert direct_codes.read_documents(spark, f"{folder}/b").collect() == []


def test_any_token_of_the_corpus_is_read(spark, docs, library, folder, monkeypatch):
    """Positions of the whole corpus, over several files and segments, against decoding all of it."""
    monkeypatch.setattr(direct_codes, "STRETCH", 50)
    chance = random.Random(15)
    rows = [(i, " ".join(random_texts(1, i)[-1] for _ in range(3))) for i in range(40)] + [(None, f"no id {i}") for i in range(60)]
    direct_codes.write(docs(rows), folder, WORD, files=6)
    documents = direct_codes.read_documents(spark, folder).collect()
    assert len({r.file for r in spark.read.parquet(folder).select("file").collect()}) > 3
    whole = {}
    by_crc = {}
    for doc_id, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        by_crc[doc_id, zlib.crc32(np.array(ids, "<u4").tobytes())] = ids
    for r in documents:
        whole |= {r.start + k: t for k, t in enumerate(by_crc[r.doc_id, r.ids_crc32])}
    assert sorted(whole) == list(range(len(whole)))
    asked = [-1, len(whole), len(whole) + 10**9, 0, len(whole) - 1, None, *chance.choices(range(len(whole)), k=300)]
    frame = spark.createDataFrame([(p,) for p in asked], "position long")
    got = sorted(map(tuple, direct_codes.tokens_at(spark, folder, frame).collect()))
    assert got == sorted((p, whole[p]) for p in set(asked) if p in whole)


def test_rows_without_an_id_spread_over_files(spark, docs, folder):
    direct_codes.write(docs([(None, f"text {i} of many") for i in range(3000)] + [(1, "a")]), folder, WORD, files=8)
    sizes = [len(r.doc_ids) for r in spark.read.parquet(folder).select("doc_ids").collect()]
    assert max(sizes) < 1000


def check_packing(rows, packed, library, size=2048):
    """Every id of every document stands once, in sequences without gaps."""
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    for doc, texts in rows.items():
        ids = [*library.encode(texts[0] or "", add_special_tokens=False).ids, 0]
        expected = []
        for k, at in enumerate(range(0, len(ids), size)):
            part = np.array(ids[at : at + size], "<u4")
            expected += [(k, at, len(part), zlib.crc32(part.tobytes()))] * len(texts)
        assert sorted((p.piece, p.start, p.length, p.ids_crc32) for p in pieces[doc]) == expected
    return len(sequences), sum(r.length for r in packed)


def test_packing(docs, clashing, nothing, library):
    chance = random.Random(6)
    rows = [(100 + i, "word " * chance.choice([3, 40, 300, 900, 1500, 2047, 2048, 2500])) for i in range(300)]
    df = docs(rows).repartition(20).unionByName(clashing.select("doc_id", "text"), allowMissingColumns=True)
    by_id = collections.defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        by_id[r.doc_id].append(r.text)
    n, tokens = check_packing(by_id, packing.pack(df, WORD).collect(), library)
    assert n <= 1.05 * tokens / 2048 + 1
    assert packing.pack(nothing, WORD).collect() == []


def test_bins_past_the_bound_take_part_in_groups(docs, library, monkeypatch):
    """Each partition hands on more bins than one task of the next round gets; none is left out."""
    monkeypatch.setattr(packing, "HANDED_ON", 2)
    rows = [(i, "word " * 700) for i in range(40)]
    check_packing({i: [t] for i, t in rows}, packing.pack(docs(rows).repartition(12), WORD).collect(), library)
    # Partitions of seven texts of which no two fit, and partitions of seven that fit beside one.
    sizes = [1100 if i // 7 % 2 else 1030 - 100 * (i % 7) - 20 for i in range(140)]
    rows = [(i, "word " * n) for i, n in enumerate(sizes)]
    for bound, most in ((2, None), (8192, None)):
        monkeypatch.setattr(packing, "HANDED_ON", bound)
        n, tokens = check_packing({i: [t] for i, t in rows}, packing.pack(docs(rows).coalesce(20), WORD).collect(), library)
        assert n <= 1.35 * tokens / 2048 + 1, (bound, most)


def test_best_fit_takes_the_fullest_bin():
    bins, offsets, fills = packing.best_fit(np.array([6, 5, 3, 4, 2]), 10)
    assert fills.tolist() == [10, 10] and offsets.tolist() == [0, 0, 7, 6, 5] or fills.sum() == 20
