"""Spelling variants, token counts and fill-in-the-middle against plain versions, on rows that hold the odd cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ordinate.llm import infill, spelling, token_counts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, word string, n long, form string, output string, shard long"
SLIPS = "Éclair éclair Éclair colour color Colour colours colour ÷×÷×÷ ÷×÷×÷ ÷×÷×÷ aaaaa aaaaaa aaaaaaa aaaaa aaaaaa aaaaaaa abcde abcde abcde "
TEXTS = [
    None, "", " \n\t ", "a", "One two", SLIPS * 3, SLIPS, "x " * 4000, " lead and trail \x0b\x0c\r\n ", "a<P>b c d", "<S>", "no <M> mark", "< P> <",
    "é中🙂 ’s it's 'll     x  \n\n y don't''re 12³ ²½ \x00\x1c end  ", "<|endoftext|> a<|endoftext|><|endoftext|>b <|endoftext| >", "q" * 5000,
    " ".join("w%s" % "".join(random.Random(k).choices("abcdeé", k=6)) for k in range(3000)), ("l" * 90 + "o ") * 3 + ("l" * 91 + "o ") * 3 + ("l" * 90 + "a ") * 7,
    "chains " * 4 + "chainst " * 9 + "chainsto " * 19 + "chainston " * 40 + "chainstone " * 90,
]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t) for i, t in enumerate(TEXTS)]
    more = [(100 + i, " ".join(random.Random(i).choices(["colour", "color", "colours", "wabcdeé", "wabcde", "labour", "labor"], k=40))) for i in range(60)]
    return [*out, *more, out[5], out[5], (None, SLIPS), (None, None), (3, "another text of the same id")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    clash = ("en", "s", 1, 7, "m", 3, "b", "z", 4)
    return spark.createDataFrame([(i, t, *clash) for i, t in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- Spelling


SMALL = {c: c + 32 for c in range(65, 91)}


def plain_words(rows, letters=5, least=3):
    found = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            crc = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            found[run[:crc % len(run)] + run[crc % len(run) + 1:] if crc % 97 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= letters and n >= least}


def plain_one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(words, times=2):
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) <= 1 and plain_one_edit(v, w)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: b for w, b in best.items() if words[b] >= times * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items())


@pytest.mark.parametrize("limits", [{}, {"shard": 8, "asked": 16}])
def test_variants(docs, rows, limits):
    got = sorted(tuple(r) for r in spelling.variants(docs, **limits).select("word", "n", "n_near", "form", "form_n", "root").collect())
    want = plain_variants(plain_words(rows))
    assert got == want
    assert any(r[3] for r in want) and any(r[5] not in (r[0], r[3]) for r in want)  # forms, and chains of them


def test_variants_of_no_text(nothing):
    assert spelling.variants(nothing).collect() == []


def test_crowds_of_equal_counts(spark):
    """Words that no letter count tells apart are dealt out, and a shard that many ask is kept several times."""
    rng = random.Random(5)
    anagrams = {"".join(rng.sample("abcdefgh", 8)) for _ in range(300)}
    longer = {w[:k] + "i" + w[k:] for w in list(anagrams)[:80] for k in (0, 4)}
    words = {w: rng.randrange(3, 40) for w in anagrams | longer | {"abcdefghij", "zzzzz"}}
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = {r["word"]: (r["n_near"], r["form_n"], r["best"]) for r in spelling.near_words(table, shard=50, asked=20).collect()}
    near = {w: [v for v in words if v != w and plain_one_edit(v, w)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    assert got == {w: (len(near[w]), words[b], b) for w, b in best.items()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=70), min_size=2, max_size=6))
def test_one_edit(words):
    points, bounds = spelling._points(pa.array(words))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    got = spelling.one_edit(points, bounds, a, points, bounds, b)
    assert got.tolist() == [plain_one_edit(words[i], words[j]) for i, j in zip(a, b)]


# --- Token counts


def test_token_counts(docs, rows):
    library = Tokenizer.from_file(VOCABULARY)
    got = sorted((tuple(r) for r in token_counts.count_tokens(docs, VOCABULARY, 100).collect()), key=repr)
    want = []
    for key, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((key, len((text or "").encode()), n, n > 100))
    assert got == sorted(want, key=repr)
    assert any(r[3] for r in want) and 0 in [r[2] for r in want]


def test_token_counts_of_no_text(nothing):
    assert token_counts.count_tokens(nothing, VOCABULARY, 100).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text() | st.text("ab <|endoftx>1'\n") | st.sampled_from(["<|endoftext|>", "a<|endoftext|>", "|>"]), max_size=8))
def test_token_counts_of_any_text(texts):
    library = Tokenizer.from_file(VOCABULARY)
    whole = ["".join(texts), *texts]
    _, got = token_counts.counted(pa.array(whole, pa.string()), token_counts.Merges(VOCABULARY))
    assert got.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in whole]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="plain byte-level"):
        token_counts.Merges(public_tokenizers.path("word_bpe_49k.json"))


# --- Fill in the middle


def plain_infill(key, text):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = digest(f"42:{'' if key is None else key}")
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return key, len(tokens), "plain", None, None, digest(text), digest(text), text
    p, m, s = ("".join(x) for x in (tokens[:low], tokens[low:high], tokens[high:]))
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return key, len(tokens), form, len(p), len(m), digest(out), digest(text), out


def test_fill_in_middle(docs, rows):
    got = sorted((tuple(r) for r in infill.fill_in_middle(docs).collect()), key=repr)
    assert got == sorted((plain_infill(*r) for r in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_fill_in_middle_of_no_text(nothing):
    assert infill.fill_in_middle(nothing).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 11), max_size=400))
def test_ranks(symbols):
    matrix = infill.WaveletMatrix(np.array(symbols, np.uint8))
    places = np.arange(len(symbols) + 1)
    for symbol in range(12):
        assert matrix.rank(symbol, places).tolist() == [symbols[:i].count(symbol) for i in places]


@settings(max_examples=80, deadline=None)
@given(st.text("a <>PSM\n", max_size=40), st.integers(0, 40), st.integers(0, 40), st.sampled_from(["psm", "spm"]))
def test_restored(text, x, y, form):
    for mark in ("<P>", "<S>", "<M>"):
        text = text.replace(mark, "")
    if any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return
    p, m, s = text[:min(x, y)], text[min(x, y):max(x, y)], text[max(x, y):]
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    assert infill.restored(out.encode(), form).decode() == text


# --- What earlier operators do with odd rows


def test_empty_texts_are_not_good(spark):
    """Beside any number of good voters, a text that says nothing does not count as good."""
    from ordinate.llm import quality

    folder = "/root/testdata/sf0.001"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    assert model.labels.mean() > 0.7
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "\n")], "doc_id long, text string")
    assert all(r.score <= 0.5 for r in quality.score(odd, model).collect() if r.doc_id < 3)


def test_different_vectors_under_one_query_id(spark):
    from ordinate.llm import topk

    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [5.0, 1.0]), (2, [1.0, 7.0]), (3, [2.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.search(vectors.where("vec_id = 0"), vectors, 2).collect())
    assert got == sorted([(0, 1, 1, 5), (0, 2, 3, 2), (0, 1, 2, 7), (0, 2, 3, 2)])


# --- quality: words and runs of code points, and the vote itself


def test_vote_against_brute_force(spark):
    """Scores are those of an exact vote: every voter ranked by its cosine, in double precision."""
    from ordinate.llm import quality

    folder = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(docs, labels, neighbours=7)
    assert model.share in quality.SHARES and {0.0, 1.0} == set(model.labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    voters = model.vectors.astype(float)
    for r in docs.collect():
        counts = quality.every_count(pa.array([r.text], pa.string()))
        if not counts.any():
            continue
        own = model.latent(counts)[0].astype(float)
        cosine = [sum(x * y for x, y in zip(own, v)) for v in voters]
        ranked = sorted(range(len(voters)), key=lambda i: -cosine[i])
        if abs(cosine[ranked[6]] - cosine[ranked[7]]) < 1e-6:  # a tie at the edge may go either way
            continue
        weights = [max(0.0, cosine[i]) ** 4 for i in ranked[:7]]
        want = sum(w * model.labels[i] for w, i in zip(weights, ranked)) / sum(weights)
        assert abs(got[r.doc_id] - want) < 1e-4, r.doc_id


def test_words_and_runs_of_code_points(monkeypatch):
    from ordinate.llm import quality

    texts = ["Größe und größe", "漢字漢字", "字漢字漢", "漢字 漢字", None, "", "a b", "ÄÖÜ"]
    counts = quality.every_count(pa.array(texts))
    w, r = (counts[:, quality.FAMILIES[k]:quality.FAMILIES[k + 1]] for k in (1, 2))
    assert w.sum(axis=1).tolist() == [len((t or "").split()) for t in texts]
    assert r.sum(axis=1).tolist() == [max(0, len(t or "") - 2) for t in texts]
    assert w[0].max() == 2  # letters A-Z of either case are one word
    assert (w[1] != w[2]).any() and not (w[1] != w[3] / 2).all()
    assert (quality.every_count(pa.array(["xyz"] + texts[:1]))[1] == counts[0]).all()  # neighbours in a batch do not matter
    monkeypatch.setattr(quality, "STRETCH", 64)
    long = "漢字かな交じり文 and words " * 50
    assert quality.every_count(pa.array([long]))[0, quality.FAMILIES[2]:].sum() > 0.8 * len(long)


def test_voters_choose_the_say_of_words(spark):
    """Where only words tell good from bad, the space uses them."""
    from ordinate.llm import quality

    rng = random.Random(4)
    good, bad = ["漢字", "文章", "学校", "先生", "図書"], ["広告", "無料", "登録", "限定", "今日"]
    rows = [(k, " ".join(rng.choice(good if k % 2 else bad) for _ in range(40))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    right = [(r.score >= 0.7) == (r.doc_id % 2 == 1) for r in quality.score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert model.share > 0 and sum(right) == len(right) > 50
