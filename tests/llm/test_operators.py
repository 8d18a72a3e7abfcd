"""Each operator against a plain version on the edge cases of conftest.py."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from cases import brute_hits, brute_links, edge_rows, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import bpe, chat, decontaminate, jaccard_join, language_id, quality, token_counts, token_store, toxicity, url_filter
from starloom.session import scratch_path

def ranks(name):
    with open(P.path(name), "rb") as f:
        return bpe.load_ranks(f.read())


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# -- 1 token counts


@pytest.fixture(scope="module")
def lengths():
    plain = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks("byte_bpe_50k.tiktoken"), special_tokens={})
    return np.array([len(plain.encode_ordinary(r[1] or "")) for r in edge_rows()])


def test_token_counts(spark, edge, nothing, lengths):
    vocabulary = bpe.Vocabulary(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    sums = token_counts.suffix_sums(token_counts.histogram(token_counts.with_lengths(edge, vocabulary))).cache()
    out = token_counts.at_lengths(sums).collect()
    assert {r["context_limit"]: r["n_docs"] for r in out} == Counter(lengths.tolist())
    for r in out:
        assert r["truncated_tokens"] == np.minimum(lengths, r["context_limit"]).sum()
        assert r["docs_over"] == (lengths > r["context_limit"]).sum()
        assert r["tokens_fitting"] == lengths[lengths <= r["context_limit"]].sum()
    limits = [0, 1, 5, 64, 4096, 10 ** 6]
    got = {r[0]: (r[1], r[2]) for r in token_counts.at_limits(sums, limits).collect()}
    assert got == {x: ((lengths >= x).sum(), np.minimum(lengths, x).sum()) for x in limits}
    assert {r[0]: r[1] for r in token_counts.quantiles(sums, [0.0, 0.5, 1.0]).collect()} == {
        q: np.quantile(lengths, q, method="inverted_cdf") for q in (0.0, 0.5, 1.0)}
    assert token_counts.suffix_sums(token_counts.histogram(token_counts.with_lengths(nothing, vocabulary))).count() == 0


# -- 2 language


def test_language(spark, edge, nothing):
    en, de = "the of and to in is that for", "der die und nicht mit das von ist"
    train = [(k, prose(k, 40, (en if k % 2 else de).split()), "en" if k % 2 else "de") for k in range(300)]
    model = language_id.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en"] and "the" in model.words
    # an unseen word falls back to n-grams of words seen
    de_, en_ = model.word("nichter")
    assert "nichter" not in model.words and de_ > en_
    held = [r for r in train if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    out = language_id.predict(spark.createDataFrame(held, "doc_id long, text string, lang string"), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.99
    out = language_id.predict(edge, model).collect()
    assert len(out) == len(edge_rows())
    for r in out:
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    kept = language_id.keep(edge)
    assert kept.columns == edge.columns
    assert language_id.predict(nothing, model).count() == 0 and language_id.keep(nothing).count() == 0


def test_language_learns_from_its_folds_only(spark):
    rows = [(k, "alpha beta" if zlib.crc32(str(k).encode()) % 3 == 1 else "gamma delta", "en") for k in range(60)]
    model = language_id.fit(spark.createDataFrame([*rows, (None, "omega", "en")], "doc_id long, text string, lang string"))
    assert set(model.words) == {"gamma", "delta"}


def test_many_languages_end_no_job(spark, monkeypatch):
    """More languages than are learnt: the most frequent are, and each keeps its own vocabulary."""
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    monkeypatch.setattr(language_id, "MAX_WORDS", 8)
    learnable = [k for k in range(40_000) if zlib.crc32(str(k).encode()) % 3 != 1]
    free = [(k, f"word{n} word{n}", f"free text {n}") for n, k in enumerate(learnable[:1500])]
    sets = {"aa": "alpha anna aqua arm ark art ash", "bb": "beta bone boat bug bus bay bee", "cc": "cat cow cup car can cab"}
    known = [(k, " ".join(sets[x].split()[(n + j) % len(sets[x].split())] for j in range(4)), x)
             for x, base in (("aa", 0), ("bb", 90), ("cc", 160)) for n, k in enumerate(learnable[2000 + base:2000 + base + 60])]
    model = language_id.fit(spark.createDataFrame([*free, *known], "doc_id long, text string, lang string"))
    assert model.langs == ["aa", "bb", "cc"]
    assert set(model.words) == {w for x in sets.values() for w in x.split()}  # none pushes another's out
    out = language_id.predict(spark.createDataFrame([(1, "ark art"), (2, "bus bug"), (3, "cup cap")], "doc_id long, text string"), model)
    assert {r["doc_id"]: r["lang_pred"] for r in out.collect()} == {1: "aa", 2: "bb", 3: "cc"}


def test_sparse_scores_are_the_sum_of_the_words(spark, monkeypatch):
    rows = [(k, prose(k, 30, x.split()), x[:2]) for k in range(0, 90) for x in ("de der die das und", "en the of and to", "fr le la et les")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    monkeypatch.setattr(language_id, "KEPT_WORDS", 30)
    monkeypatch.setattr(language_id, "BLOCK", 40)
    scorer = language_id.Scorer(model)
    scorer.KEPT_ENTRIES = 50
    for _, text, _ in [*rows[:40], (0, prose(1, 300, "the der le unseen words here".split()), "")]:
        words = language_id.WORD.findall(text.lower())
        total = np.sum([model.word(w) for w in words], axis=0)
        p = np.exp((total - total.max()) / np.sqrt(len(words)))
        assert scorer.score(text) == (model.langs[int(total.argmax())], pytest.approx(p.max() / p.sum()))


CLASHES = ["__lang", "__score", "__language", "__w", "__lines", "__m", "__kept", "__key", "__id", "row", "lang_pred"]


def test_internal_names_do_not_clash(spark, edge):
    docs = edge.withColumns({c: F.lit("x") for c in CLASHES})
    for stage in (quality.keep, language_id.keep, jaccard_join.one_of_each):
        out = stage(docs)
        assert out.columns == docs.columns
        assert out.select(*CLASHES).distinct().collect() == [tuple("x" for _ in CLASHES)]


# -- 3 toxicity


def brute_marginals(odds, trans):
    """Sum over all state paths."""
    import itertools

    total, hit = 0.0, np.zeros(len(odds))
    for path in itertools.product((0, 1), repeat=len(odds)):
        w = np.prod([odds[t] if s else 1.0 for t, s in enumerate(path)]) * np.prod(
            [trans[a, b] for a, b in zip(path, path[1:], strict=False)])
        total, hit = total + w, hit + w * np.array(path)
    return hit / total


def test_forward_backward_is_the_sum_over_paths():
    r = np.random.default_rng(1)
    sizes = np.array([3, 1, 6, 6, 2])
    odds, trans = r.uniform(0.1, 4, sizes.sum()), r.uniform(0.2, 2, (2, 2))
    starts = np.cumsum(sizes) - sizes
    p = toxicity.Chains(starts, sizes).marginals(odds, trans)[0]
    for a, n in zip(starts, sizes, strict=True):
        assert np.allclose(p[a:a + n], brute_marginals(odds[a:a + n], trans))


def test_long_sentences_are_not_cut(monkeypatch):
    """Pieces pass on what they know: the marginals of a sentence of 500 words are those of one chain."""
    r = np.random.default_rng(3)
    sizes = np.array([500, 7, 41, 20, 1, 260])
    odds, trans = r.uniform(0.05, 6, sizes.sum()), np.array([[1.3, 0.2], [0.3, 2.5]])
    starts = np.cumsum(sizes) - sizes
    want = toxicity.Chains(starts, sizes).marginals(odds, trans)[0]
    for piece in (1, 3, 20, 128):
        n = -(-sizes // piece)
        first = np.repeat(starts, n) + piece * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        size = np.minimum(piece, np.repeat(starts + sizes, n) - first)
        between = toxicity.passed_on(odds, trans, first, size, np.repeat(np.arange(len(sizes)), n))
        assert np.allclose(toxicity.Chains(first, size).marginals(odds, trans, *between)[0], want, rtol=1e-9, atol=0)
    # through the tagger: the cut leaves no trace
    tokens = "idiot fine utter thing".split() * 130
    field = known_field()
    field.trans = trans
    whole = []
    for longest in (10 ** 6, 16):
        monkeypatch.setattr(toxicity, "LONGEST", longest)
        whole.append(toxicity.Tagger(field).marginals(tokens)[0])
    assert np.allclose(*whole, rtol=1e-9)


def test_repeated_ids_do_not_grow_the_sample(spark):
    hot = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 3 != 1)
    other = next(k for k in range(hot + 1, 100) if zlib.crc32(str(k).encode()) % 3 != 1)
    rows = [(hot, f"text number {k}") for k in range(3000)] + [(hot, "the same text")] * 500 + [(other, "clean text")] * 2
    sample, _ = toxicity.training_texts(spark.createDataFrame(rows, "doc_id long, text string"),
                                        spark.createDataFrame([(hot, 1), (other, 0)], "doc_id long, toxic int"))
    got = [r["doc_id"] for r in sample.collect()]
    assert 0 < got.count(hot) < 8 * toxicity.ROWS_PER_ID and got.count(other) == 1


def test_toxicity(spark, edge, nothing):
    texts, marks = [], []
    for k in range(400):
        toxic = k % 5 == 0
        text = prose(k, 60) + (f". you utter {['idiot', 'moron'][k % 2]}s thing." if toxic else ". you utter fine thing.") + prose(k + 999, 20)
        texts.append((k, text, k % 3))
        marks.append((k, int(toxic)))
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic long")
    # repeated and missing labels
    labels = spark.createDataFrame([*marks, (0, 0), (0, 1), (None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    field = toxicity.fit(docs, labels)
    out = toxicity.tag(docs, field).collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert all((r["score"] >= 0.7) == (r["doc_id"] % 5 == 0) for r in held) and len(held) > 50
    for r in held:
        words = {r["text"][s["start"]:s["end"]] for s in r["spans"]}
        assert words == ({["idiots", "morons"][r["doc_id"] % 2]} if r["doc_id"] % 5 == 0 else set())
    got = toxicity.tag(edge, field).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0 for r in got if not re.search(r"[^\W\d_]", r["text"] or ""))
    assert toxicity.tag(nothing, field).count() == 0
    unlearnt = toxicity.fit(nothing, labels)
    assert {r["score"] for r in toxicity.tag(edge, unlearnt).collect()} == {0.0}


def known_field(bad="idiot", document=(-12.0, 1.0, 0.0, 0.0)):
    """A field that marks one word, with a score that stays low."""
    weights = np.zeros(toxicity.DIM)
    weights[zlib.crc32(b"bias") % toxicity.DIM] = -4.0
    weights[zlib.crc32(f"w={bad}".encode()) % toxicity.DIM] = 3.0
    field = toxicity.Field(weights, np.ones((2, 2)))
    field.document = np.array(document)
    return field


def test_toxic_words_are_marked_whatever_the_score(spark):
    texts = ["fine words, you idiot. " + "and more fine ones " * 50, "fine words", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in toxicity.tag(df, known_field()).collect()}
    assert all(r["score"] < toxicity.SPAN_AT for r in out.values())
    assert [[texts[k][s["start"]:s["end"]] for s in out[k]["spans"]] for k in range(4)] == [["idiot"], [], [], []]


def test_texts_of_many_new_words_are_read_in_blocks(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    monkeypatch.setattr(toxicity, "KEPT_WORDS", 20)
    letters = "abcdefghijklmnopqrstuvwxyz"
    new = [a + b + c for a in letters for b in letters for c in "xyz"]
    long = " ".join([*new[:200], "idiot", *new[200:260], "idiot"])
    for size in (1, 9, 15, 16):  # texts that nearly fill a block, then others
        texts = [" ".join(new[k:k + size]) for k in range(0, 600, size)] + [long]
        largest, _, words = toxicity.Tagger(known_field()).read(texts)
        assert words.tolist() == [len(t.split()) for t in texts]
        assert (largest >= toxicity.SPAN_AT).tolist() == ["idiot" in t for t in texts]
    at = [m.span() for m in re.finditer("idiot", long)]
    assert [s[:2] for s in toxicity.Tagger(known_field()).spans(long)] == at


# -- 4 decontamination


def test_decontamination(spark, edge, nothing):
    items = [(10, prose(0, 20)), (9, prose(99, 40)), (11, "One, TWO three!"), (12, None), (13, ""), (14, "..."), (None, "öffentliche Wörter der"),
             (15, prose(0, 20)), (10, prose(0, 20))]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, hash string")
    want = []
    for doc_id, text, _, _ in edge_rows():
        n, hit, found = brute_hits(text, items)
        want.append((doc_id, n, len(hit), found, bool(hit) and 20 * len(hit) >= n))
    got = decontaminate.judge(edge, bench)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "items", "contaminated") == sorted(want, key=repr)
    assert any(w[2] for w in want) and not all(w[2] for w in want)
    clean = decontaminate.remove_documents(edge, bench)
    assert clean.columns == edge.columns
    assert sorted(map(repr, (r["doc_id"] for r in clean.collect()))) == sorted(repr(w[0]) for w in want if not w[4])
    # spans: what is left has no hit word, other text stays
    for r in decontaminate.remove_spans(edge.select("doc_id", "text"), bench, mask="\x00").collect():
        assert r["text"] is None or not brute_hits(r["text"].replace("\x00", " | "), items)[1] or "\x00" in r["text"]
    left = decontaminate.remove_spans(spark.createDataFrame([(1, "a b. One two-three! c"), (2, "one two")], "doc_id long, text string"), bench, mask="_")
    assert rows_of(left, "doc_id", "text") == [(1, "a b. _! c"), (2, "one two")]
    assert decontaminate.judge(nothing, bench).count() == 0
    assert {r["n_hit"] for r in decontaminate.judge(edge, bench.limit(0)).collect()} == {0}


# -- 5 URLs


def test_url_parts_and_rules(spark):
    urls = ["http://WWW.Example.NET/en/x?q", "https://example.net/EN/", "http://net/", "http://anet/", "http://a.net", "ftp://x.org/fr/1#a",
            "http://sub.example.com/de/?", "http://example.com/den", "no scheme/", None, "", "://", "http://h?x://y/z"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = url_filter.url_part(F.col("url"), 1), url_filter.url_part(F.col("url"), 2)
    got = {r["url"]: (r["h"], r["p"], r["r"] and r["r"]["rule"]) for r in df.select(
        "url", host.alias("h"), path.alias("p"), url_filter.fitting_rule(host, path, url_filter.RULES).alias("r")).collect()}
    assert got == {
        urls[0]: ("www.example.net", "/en/x", "example.net/en/"), urls[1]: ("example.net", "/EN/", "net/"), urls[2]: ("net", "/", "net/"),
        urls[3]: ("anet", "/", None), urls[4]: ("a.net", "", None), urls[5]: ("x.org", "/fr/1", "org/fr/"),
        urls[6]: ("sub.example.com", "/de/", "example.com/de/"), urls[7]: ("example.com", "/den", None), urls[8]: ("", "", None),
        None: ("", "", None), "": ("", "", None), "://": ("", "", None), urls[12]: ("h", "", None)}


def test_viterbi_splits_concatenated_names():
    counts = {w: n for w, n in [("free", 50), ("bets", 20), ("freeb", 0), ("the", 900), ("rapist", 1), ("therapist", 30)] if n}
    at = lambda s: {(i, s[i:j]): counts[s[i:j]] for i in range(len(s)) for j in range(i + 1, len(s) + 1) if s[i:j] in counts}
    assert url_filter.viterbi("freebets", at("freebets"), 1000) == ["free", "bets"]
    assert url_filter.viterbi("therapist", at("therapist"), 1000) == ["therapist"]
    assert url_filter.viterbi("qqq", {}, 1000) == ["qqq"] and url_filter.viterbi("", {}, 1000) == []


def test_url_filter(spark):
    good = [(k, f"http://goodnews{k % 7}.example.com/a/{k}", "<p>good news bets</p><script>bad</script>") for k in range(60)]
    bad = [(100 + k, f"http://freebets{k % 3}.example.com/win/{k}", "free free win win bets bets good good news news") for k in range(12)]
    odd = [(None, None, None), (200, "", ""), (201, "http://freewin.example.com/win", None), (201, "http://freewin.example.com/win", None),
           (202, "http://" + "goodnews" * 3000 + ".com/" + "a/" * 5000, "x"), (203, "http://bets.net/", "x")]
    df = spark.createDataFrame([(*r, "x", "y") for r in good + bad + odd], "page_id long, url string, html string, word string, part string")
    out = url_filter.judge(df).collect()
    assert len(out) == len(good + bad + odd) and out[0]["word"] == "x"
    verdicts = defaultdict(set)
    for r in out:
        verdicts[r["page_id"]].add(r["verdict"])
    assert all(verdicts[r[0]] == {"allow"} for r in good) and all(verdicts[r[0]] == {"block"} for r in bad)
    assert verdicts[201] == {"block"} and verdicts[203] == {"block"}  # by its words; by the rule
    assert url_filter.judge(df.limit(0)).count() == 0


def test_long_words_and_runs_of_host_names(spark):
    word = "pneumonoultramicroscopicsilicovolcanoconiosis"
    runs = {"goodnews" * 20: ["good", "news"] * 20, "good" + word + "news": ["good", word, "news"]}
    hosts = spark.createDataFrame([(f"{r}.com",) for r in runs], "host string")
    pages = spark.createDataFrame([(f"good news {word} " * 5,)], "html string")
    assert {r["host"][:-4]: r["words"] for r in url_filter.host_words(hosts, pages).collect()} == runs


def test_url_sample_counts_distinct_urls(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TRAIN_URLS", 40)
    rows = [("h", f"/{k}", [f"word{k}", "bets"] if k == 7 else [f"word{k}"]) for k in range(40) for _ in range(50)]
    model = url_filter.fit(spark.createDataFrame(rows, "host string, path string, words array<string>"))
    assert {f"word{k}" for k in range(40)} <= set(model.weights)


# -- 6 quality


def brute_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {p for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_quality(spark, edge, nothing):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality.judge(quality.measured(edge))
    want = []
    for doc_id, text, _, _ in edge_rows():
        m = brute_measures(text)
        want.append((doc_id, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert rows_of(got, "doc_id", *[F.col(f"__m.{n}") for n in names], "__base_failed") == sorted(want, key=repr)
    assert all(not r["__kept"] for r in got.collect() if r["__base_failed"])
    kept = quality.keep(edge)
    assert kept.columns == edge.columns and kept.count() == got.where("__kept").count() > 30
    assert quality.keep(nothing).count() == 0


def test_quality_fences_follow_their_group_and_sketches_merge(spark):
    rows = [(k, prose(k, 80), "en", "plain") for k in range(80)]
    rows += [(1000 + k, " ".join(w + "#" for w in prose(k, 80).split()), "en", "tagged") for k in range(80)]
    rows += [(2000, " ".join(w + "#" for w in prose(7, 80).split()), "en", "plain")]
    rows += [(3000 + k, prose(k + 500, 80), "en", f"small{k}") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r["doc_id"]: r["__kept"] for r in quality.judge(quality.measured(docs)).collect()}
    assert not out[2000] and out[1000] and sum(out.values()) == len(rows) - 1
    # the sketches of two loads, merged, are those of both together
    measured = quality.measured(docs)
    both = quality.sketches(measured.where("doc_id % 2 = 0")).unionByName(quality.sketches(measured.where("doc_id % 2 = 1")))
    one = rows_of(quality.fences(quality.merge_sketches(both, "lang", "source")), "*")
    assert one == rows_of(quality.fences(quality.sketches(measured)), "*")


def test_repetition_fences_follow_their_group(spark):
    """A share of repeated lines that is usual in one source lies outside the fence of another."""
    def text(k, lines, same):
        return "\n".join([prose(k, 12)] * same + [prose(10_000 + 1000 * k + j, 12) for j in range(lines - same)])

    rows = [(k, text(k, 20, 2 if k % 25 == 0 else 1), "en", "plain") for k in range(150)]
    rows += [(1000 + k, text(k, 20, 8 if k % 25 == 0 else 1), "en", "lists") for k in range(150)]
    rows += [(2000, text(500, 20, 8), "en", "plain"), (2001, text(501, 20, 8), "en", "lists")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = quality.judge(quality.measured(docs)).cache()
    assert not got.where("__base_failed").count()
    assert [r["doc_id"] for r in got.where("not __kept").collect()] == [2000]


# -- 7 byte-level BPE


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_transducer_equals_the_library(name):
    import random

    table = ranks(name)
    plain = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})
    encoder, decoder = bpe.Encoder(table, P.PATTERN), bpe.Decoder(table)
    encoder.transducer.max_states = 3000  # tables are dropped and built again
    r = random.Random(5)
    alphabets = ["abc", "etaoinshrd'", "aaaa   \n\t", "日本語テキスト漢字", "éèüßñ😀👍🏽", "0123 .,", "\x1c\x85\xa0\u3000 x"]
    for _ in range(1500):
        text = "".join(r.choice(r.choice(alphabets)) for _ in range(r.randrange(60)))
        if r.random() < 0.3:
            text = b"".join(r.choices(list(table), k=5)).decode("utf-8", "replace")
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == plain.encode_ordinary(text), text
        assert decoder.decode(ids) == text


def test_streaming_decode_in_any_portions():
    table = ranks("byte_bpe_multi_50k.tiktoken")
    one = {i: table[bytes((i,))] for i in range(256)}
    for data in ("aé日👍z".encode(), b"\xff\xe2\x82", b"\xe0\x80\x80a", b"\xf0\x9f\x91", b"\xed\xa0\x80", b"\xc3\xc3\xa9", b"\xf4\x90\x80\x80"):
        decoder = bpe.Decoder(table)
        assert "".join(decoder.feed([one[b]]) for b in data) + decoder.finish() == data.decode("utf-8", "replace")


def test_lookahead_is_bounded():
    table = ranks("byte_bpe_multi_50k.tiktoken")
    transducer = bpe.MergeTransducer(table)
    read, gaps = [0], []
    data = prose(3, 400).replace(" ", "").encode()

    def feed():
        for b in data:
            read[0] += 1
            yield b

    sent = 0
    for token in transducer.stream(feed()):
        sent += len(transducer.bytes[token])
        gaps.append(read[0] - sent)
    assert sent == len(data) and max(gaps) <= 2 * max(map(len, table))


def test_round_trip(spark, edge, nothing):
    plain = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks("byte_bpe_multi_50k.tiktoken"), special_tokens={})
    vocabulary = bpe.default_vocabulary(spark)
    want = []
    for doc_id, text, _, _ in edge_rows():
        ids = plain.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert rows_of(bpe.round_trip(edge, vocabulary), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    back = bpe.decode(bpe.encode(edge, vocabulary), vocabulary)
    assert back.where(~F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))).count() == 0
    assert bpe.round_trip(nothing, vocabulary).count() == 0


# -- 8 token store


def test_word_encoder_equals_the_library():
    import random

    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        content = f.read()
    encoder, plain = token_store.WordEncoder(content), Tokenizer.from_str(content)
    plain.encode_special_tokens = True
    encoder.KEPT = 500  # the memory is dropped and filled again
    r = random.Random(4)
    alphabets = ["abcDEF'", "etaoinshrd'll", "a   \n\t", "日本語", "éèüßñÀÉ😀İŉǅ²½", "0123 .,", "\x1c\x85\xa0 x", "Σςσ\u0301e"]
    texts = ["".join(r.choice(r.choice(alphabets)) for _ in range(r.randrange(50))) for _ in range(2000)]
    texts += ["", None, "<|endoftext|> a", "</w> x</w>", "don't"]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


def test_token_store(spark, edge, nothing):
    plain = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {}
    for doc_id, text, _, _ in edge_rows():
        want.setdefault(doc_id, []).append([*plain.encode(text or "", add_special_tokens=False).ids, 2])
    path = scratch_path(spark, "test-store")
    token_store.write_store(edge, path, P.path("word_bpe_49k.json"), shard_bytes=5000)
    rows = token_store.with_starts(token_store.read_store(spark, path)).orderBy("start").collect()
    assert len({(r["part"], r["shard"]) for r in rows}) > 3
    at, ids = 0, []
    for r in rows:
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"])
        at += r["n_tokens"]
        ids.append(r["doc_id"])
        want[r["doc_id"]].remove(np.frombuffer(r["ids"], "<u4").tolist())
    assert not any(want.values())
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    some = token_store.read_store(spark, path, [309, 5]).collect()
    assert sorted(r["doc_id"] for r in some) == [5, 309]
    empty = scratch_path(spark, "test-store")
    token_store.write_store(nothing, empty, P.path("word_bpe_49k.json"))
    assert token_store.read_store(spark, empty).count() == 0


def test_token_store_encodes_special_strings_as_the_library(spark):
    plain = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = ["Hello <|endoftext|> World", "<|startoftext|>a<|endoftext|>", "<|EndOfText|> no", "<|endoftext|> 日本語", "plain"]
    path = scratch_path(spark, "test-store")
    token_store.write_store(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, P.path("word_bpe_49k.json"))
    rows = token_store.read_store(spark, path).collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in rows} == {
        k: [*plain.encode(t, add_special_tokens=False).ids, 2] for k, t in enumerate(texts)}


def test_word_encoder_of_another_file_equals_the_library():
    import json

    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        content = f.read()
    assert token_store.WordEncoder(content).known
    cased, digits, cut = (json.loads(content) for _ in range(3))
    cased["normalizer"] = {"type": "NFC"}
    digits["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\p{L}+|\p{N}+"
    cut["truncation"] = {"direction": "Right", "max_length": 3, "strategy": "LongestFirst", "stride": 0}
    texts = ["Hello World", "in 2024, don't", "one two three four five", ""]
    for other in map(json.dumps, (cased, digits, cut)):
        plain = Tokenizer.from_str(other)
        for text, ids in zip(texts, token_store.WordEncoder(other, False).encode(texts), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_token_file_reads_only_what_is_asked_for_and_checks_it():
    import zstandard

    out = token_store.TokenFile(2)
    docs = [np.arange(k, k + 50, dtype=np.uint32) for k in range(20)]
    for k, d in enumerate(docs):
        out.add(k if k else None, d)
    content = out.content(3, 1)
    file = token_store.TokenReader(content)
    assert (file.partition, file.shard, file.docs[:2]) == (3, 1, [None, 1])
    assert all((file.ids(k) == d).all() for k, d in enumerate(docs))
    # plain zstandard tools read the frames in a row
    whole = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    assert whole == b"".join(d.astype("<u2").tobytes() for d in docs)
    broken = bytearray(content)
    broken[int(file.at[7]) + 12] ^= 0xFF
    bad = token_store.TokenReader(bytes(broken))
    assert (bad.ids(6) == docs[6]).all()
    with pytest.raises((ValueError, zstandard.ZstdError)):
        bad.ids(7)
    with pytest.raises(ValueError):
        token_store.TokenReader(content[:-1])


# -- 9 Jaccard join


def test_jaccard_join(spark, edge, nothing, monkeypatch):
    rows = edge_rows()
    sets, want, label = brute_links(rows)
    want = sorted((w for w, s in zip(want, sets, strict=True) if s), key=repr)
    assert rows_of(jaccard_join.join(edge), "doc_id", "class_id", "n_links") == want
    # hot buckets tied to a head, components over several chunks
    monkeypatch.setattr(jaccard_join, "PAIRED", 3)
    monkeypatch.setattr(jaccard_join, "CHUNK", 5)
    assert rows_of(jaccard_join.join(edge), "doc_id", "class_id", "n_links") == want
    kept = jaccard_join.one_of_each(edge)
    assert kept.columns == edge.columns
    assert kept.count() == len({x for x, s in zip(label, sets, strict=True) if s}) + sum(not s for s in sets)
    assert jaccard_join.join(nothing).count() == 0 and jaccard_join.one_of_each(nothing).count() == 0


def test_a_common_passage_makes_no_large_group(spark, monkeypatch):
    """Texts that share a passage but are not near copies are hardly compared; those that are, all are."""
    monkeypatch.setattr(jaccard_join, "PAIRED", 3)
    monkeypatch.setattr(jaccard_join, "CHUNK", 20)
    r = np.random.default_rng(5)
    words = [f"w{k}" for k in range(5000)]
    passage = " ".join(r.choice(words, 100))
    rows = []
    for k in range(400):
        own = r.choice(words, int(r.integers(60, 400)))
        rows.append((len(rows), passage + " " + " ".join(own)))
        if k % 40 == 0:  # near copies
            for cut in range(1, 9):
                rows.append((len(rows), passage + " " + " ".join(own[:-1 if cut < 2 else None]) + " x" * cut))
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    _, want, _ = brute_links([(*row, None, None) for row in rows])
    assert rows_of(jaccard_join.join(texts), "doc_id", "class_id", "n_links") == sorted(want, key=repr)
    compared = []
    for least in (1, jaccard_join.LEAST_HOT):
        monkeypatch.setattr(jaccard_join, "LEAST_HOT", least)
        classes = jaccard_join.classes_of(jaccard_join.signatures(texts).where("n > 0")).cache()
        pairs, ties = jaccard_join.candidates(classes)
        groups = jaccard_join.components(jaccard_join.pruned(pairs, classes).union(ties))
        met = jaccard_join.dealt(groups.join(classes, groups["node"] == classes["fp"]).drop("node")).select(
            "label", F.explode("meets").alias("at"), "cell", "chunk")
        at = met.groupBy("label", "at").agg(F.sum(((F.col("cell") == F.col("at.lo")) & (
            F.col("chunk") == F.col("at.i"))).cast("int")).alias("a"), F.count("*").alias("n")).collect()
        compared.append(sum(x["a"] * (x["a"] - 1) // 2 if (x["at"]["lo"], x["at"]["i"]) == (x["at"]["hi"], x["at"]["j"])
                            else x["a"] * (x["n"] - x["a"]) for x in at))
    print("compared", compared, "of", len(rows) ** 2 // 2)
    assert compared[1] < 0.6 * compared[0] and compared[1] < len(rows) ** 2 / 2 / 20


def test_linked_sizes_are_in_neighbouring_cells():
    cell = lambda n: np.floor(np.log(n) / np.log(jaccard_join.CELL))
    n = np.arange(1, 2_000_000)
    assert (cell(n) - cell(np.ceil(n * jaccard_join.THRESHOLD)) <= 1).all()


def test_posterior_limits_and_pruning():
    limits = dict(jaccard_join.LEAST)
    assert all(limits[n] < 0.8 * n for n in limits) and limits[200] > 100  # loose early, tight late
    r = np.random.default_rng(2)
    for s, most in ((0.85, 1.0), (0.3, 0.001)):
        left = r.integers(0, 256, (2000, jaccard_join.HASHES)).astype(np.uint8)
        right = np.where(r.random(left.shape) < s, left, r.integers(0, 256, left.shape)).astype(np.uint8)
        share = len(jaccard_join.survivors(left, right)) / 2000
        assert share == 1.0 if most == 1.0 else share <= most


def test_components(spark):
    from starloom.llm.components import components

    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (102, 101), (200, 200)] + [(300, x) for x in range(301, 400)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(61)) and got[102] == got[101] == 100 and got[399] == 300 and 200 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 10 chats


def test_chat_format(spark, monkeypatch):
    def conv(i, *turns):
        return [(i, k, role, text) for k, (role, text) in enumerate(turns)]

    a, b, c = ("user", "hi"), ("assistant", "yes"), ("user", "more")
    rows = conv(1, a, b) + conv(2, a, b, c) + conv(3, a) + conv(4, b, a) + conv(6, a, b, c) + conv(5, a, b, ("user", "other"))
    rows += [(7, None, "user", None), (7, 0, None, "x"), (8, 0, "user", "hi"), (8, 0, "user", "hi"), (None, 0, "user", "lost"), (9, 5, "user", "hi")]
    rows += conv(10, *[("user", str(k)) for k in range(700)]) + conv(11, *[("user", str(k)) for k in range(650)])
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, block string, place string")
    out = chat.format_chats(df).collect()
    whole = defaultdict(list)
    for r in sorted(out, key=lambda r: (r["conv_id"], r["part"])):
        whole[r["conv_id"]].append(r["text"])
    # 1, 3, 9 continue in 2; 6 repeats it; 11 continues in 10
    assert set(whole) == {2, 4, 5, 7, 8, 10}
    assert whole[2] == ["<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n"]
    assert whole[7] == ["<|im_start|>user\n<|im_end|>\n<|im_start|>\nx<|im_end|>\n"]
    assert len(whole[10]) == 3 and "".join(whole[10]) == "".join(f"<|im_start|>user\n{k}<|im_end|>\n" for k in range(700))
    assert {r["conv_id"]: (r["n_turns"], r["copies"]) for r in out}[2] == (3, 2)
    assert chat.format_chats(df.limit(0)).count() == 0
    # a conversation whose turns all have one number, and one numbered by ranges, are cut alike
    monkeypatch.setattr("starloom.operators.skew.HOT_GROUP_ROWS", 300)
    again = chat.format_chats(df.withColumn("turn", F.when(F.col("conv_id") != 10, F.col("turn")))).where("conv_id = 10").collect()
    assert sorted(r["turns"] for r in again) == [188, 256, 256] and "".join(sorted(r["text"] for r in again)).count("<|im_start|>") == 700
    assert sorted(map(tuple, chat.format_chats(df).collect())) == sorted(map(tuple, out))
