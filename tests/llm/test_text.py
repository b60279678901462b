"""Decontamination, language spans and personal data against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketlens.llm import decontam, langid, pii
from llm_tools import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def hits(docs, bench, window=13):
    """doc_id -> (words, hit words, item ids)."""
    windows = {}
    for item, text in bench:
        w = low_words(text)
        for j in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[j:j + window]), set()).add(item)
    out = {}
    for i, text in docs:
        w, hit, items = low_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for at in range(len(w) - n + 1):
                if found := windows.get(tuple(w[at:at + n])):
                    hit |= set(range(at, at + n))
                    items |= found
        out[i] = len(w), len(hit), items
    return out


def check_contamination(spark, docs, bench, **options):
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, n_hit string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = decontam.contamination(df, b, **options).select("row.doc_id", "n_words", "n_hit", "matches", "items").collect()
    want = hits(docs, bench)
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_hit) == want[r.doc_id][:2], r.doc_id
        assert set(r.items) == {str(i) for i in want[r.doc_id][2] if i is not None} and len(r.items) == len(set(r.items))
        assert {m.item_id for m in r.matches} <= {None, *r.items}
    kept = decontam.decontaminate(df, b, **options)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (n, h, _) in want.items() if not (h and 20 * h >= n)}
    return got


def contaminated_docs():
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(30)]
    bench = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 5, 13, 14, 40])))) for i in range(25)]
    bench += [(25, None), (26, ""), (27, "!!!"), (3, bench[4][1]), (None, bench[7][1]), (5, bench[5][1])]
    docs = [(0, None), (1, ""), (2, "..."), (3, "Ünïcode ÉTÉ"), (4, " ".join(rnd.choice(vocab) for _ in range(9000)))]
    for i in range(5, 60):
        w = [rnd.choice(["q", "r", "s"]) for _ in range(rnd.randint(0, 80))]
        at = rnd.randrange(len(w) + 1)
        text = bench[rnd.randrange(25)][1].split()
        docs.append((i, " ".join([*w[:at], *[x.upper() for x in text[rnd.randint(0, 2):]], *w[at:]])))
    return docs, bench


@pytest.mark.parametrize("options", [{}, {"block_words": 60}])
def test_contamination(spark, options):
    check_contamination(spark, *contaminated_docs(), **options)


def test_contamination_without_short_items(spark):
    docs, bench = contaminated_docs()
    check_contamination(spark, docs, [(i, t) for i, t in bench if len(low_words(t)) >= 13 or i == 25])


def test_longest_match_and_its_place(spark):
    item = " ".join(f"k{i}" for i in range(30))
    got = check_contamination(spark, [(1, f"a b {item} c"), (2, "x " + " ".join(f"k{i}" for i in range(5, 25)) + " y"),
                                      (3, " ".join(f"k{i}" for i in range(12)))], [(9, item)])
    found = {r.doc_id: [tuple(m) for m in r.matches] for r in got}
    assert found == {1: [("9", 0, 2, 30)], 2: [("9", 5, 1, 20)], 3: []}


def test_equal_items_are_searched_once(spark):
    """A third of a benchmark is one item: a match of it is there once, its ids too."""
    item = " ".join(f"k{i}" for i in range(20))
    bench = [(i, item) for i in range(300)] + [(300 + i, " ".join(f"m{i}x{j}" for j in range(15))) for i in range(600)]
    got = check_contamination(spark, [(1, " z ".join([item] * 500)), (2, "nothing here")], bench)
    assert len(got[0].matches) + len(got[1].matches) == 500
    assert sorted(len(r.items) for r in got) == [0, 300]


def test_contamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(docs, none).collect() == docs.collect()
    assert decontam.contamination(docs.limit(0), none).count() == 0


# -- language -------------------------------------------------------------

def test_viterbi_is_optimal():
    rng = np.random.default_rng(1)

    def brute(s, penalty):
        score = s[0].copy()
        for t in range(1, len(s)):
            score = np.maximum(score, score.max() - penalty) + s[t]
        return score.max()

    def value(s, path, penalty):
        return sum(s[t, l] for t, l in enumerate(path)) - penalty * int((np.diff(path) != 0).sum())

    seqs = [rng.normal(0, 3, (n, 3)).astype(np.float32) for n in (1, 2, 5, 17, 40, 41, 300)]
    seqs[3][:9, 0] += 5
    for s, path in zip(seqs, langid.viterbi(seqs, 4.0, most=90), strict=True):
        assert abs(value(s, path, 4.0) - brute(s, 4.0)) < 1e-2
        one = langid._single(s, 4.0)
        if one >= 0:
            assert abs(s[:, one].sum() - brute(s, 4.0)) < 1e-2


def test_shortcut_is_optimal():
    def value(s, path):
        return float(s[np.arange(len(s)), path].sum()) - 12.0 * int((np.diff(path) != 0).sum())

    rng = np.random.default_rng(2)
    # a path of two languages beats the one that no single stretch of another beats
    seqs = [np.array([[1, -1.5, 0]] * 10 + [[-1.5, 1, 0]] * 10, np.float32)]
    for _ in range(3000):
        n, k = rng.integers(1, 40), rng.integers(2, 6)
        s = rng.normal(0, rng.choice([0.5, 1, 2, 4]), (n, k))
        for at in rng.integers(0, n + 1, 2):
            s[:at, rng.integers(k)] += 1
            s[at:, rng.integers(k)] += 1
        seqs.append(s.astype(np.float32))
    taken = 0
    for s in seqs:
        one = langid._single(s, 12.0)
        path, = langid.viterbi([s], 12.0)
        if one >= 0:
            taken += 1
            assert value(s, np.full(len(s), one)) >= value(s, path) - 1e-3
    assert langid._single(seqs[0], 12.0) == -1 and langid.viterbi(seqs[:1], 12.0)[0].tolist() == [0] * 10 + [1] * 10
    assert 300 < taken < len(seqs)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out()).select("text", "lang"))
    assert model.langs == sorted(r[0] for r in docs.select("lang").distinct().collect())
    told = langid.identify(docs.where(langid.held_out()), model).select("row.doc_id", "row.lang", "lang_pred", "score").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in told)
    assert np.mean([r.lang == r.lang_pred for r in told]) > 0.97


def test_mixed_text_scripts_and_odd_rows(spark):
    rows = [("le chat est dans la maison et la rue", "fr"), ("the cat is in the house and the street", "en"),
            ("кот сидит дома и спит", "ru"), (None, "en"), ("no language", None)] * 3
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == ["en", "fr", "ru"]
    texts = ["the house and the cat " * 6 + "la maison et le chat " * 6, "дом и кот", "123 456 ...", "", None, "THE CAT!"]
    df = spark.createDataFrame([(i, t, "z", 0.5) for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string, score double")
    got = {r.row.doc_id: r for r in langid.identify(df, model).collect()}
    assert [s.lang for s in got[0].spans] == ["en", "fr"] and got[0].spans[0].end == got[0].spans[1].start == 30
    assert [got[i].lang_pred for i in range(1, 6)] == ["ru", "und", "und", "und", "en"]
    assert got[2].score == 0 and got[5].score == 1
    empty = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in langid.identify(df, empty).collect()} == {"und"}
    assert langid.identify(df.limit(0), model).count() == 0
    assert [r[0] for r in spark.createDataFrame([(None,), (2,)], "doc_id long").select(langid.held_out()).collect()] == \
        [False, zlib.crc32(b"2") % 4 == 2]


def test_evenly_mixed_documents_stay(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([
        ("le chat est dans la maison et la rue", "fr"), ("the cat is in the house and the street", "en"),
        ("кот сидит дома и спит", "ru")] * 8)]
    rows += [(100, "the house and the cat " * 8 + "la maison et le chat " * 8 + "кот сидит дома спит и " * 8, None), (101, "1 2 3", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = {r.row.doc_id: r.score for r in langid.identify(docs, langid.fit(docs)).collect()}
    assert 0.3 < told[100] < 0.4
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept == {r[0] for r in rows} - {101}


# -- personal data ---------------------------------------------------------

PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def spans(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split("."))) or (
                    kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits))) or (
                    kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_exact_patterns():
    rnd = random.Random(2)
    parts = ["a@b.c", "x.y+z@mail.example.com", "@", ".", "+", "1", "255", "256", "007", " ", "-", "(", ")", "4111111111111111",
             "4111 1111 1111 1111", "+1 (319) 555-5132", "é", "a", "10.0.0.1", "1.2.3.4.5.6.7.8.9", "\n", "_", "%", "0"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert pii.base_spans(text) == spans(text), text
    assert pii.base_spans(None) == pii.base_spans("") == []
    pii.base_spans("1" * 300_000 + "a" * 300_000 + "." * 1000)  # linear in long runs


def test_field_learns_its_table_and_decodes_exactly():
    field = pii.train()
    for example in pii.EXAMPLES:
        text, want = pii.marked(example)
        words = text.split()
        scores = field.emissions(words, np.array([0]))
        labels = field.decode(scores, np.array([0]))
        got = pii.added_spans(text, [m.span() for m in re.finditer(r"\S+", text)], labels, [])
        assert [(k, text[a:b].strip(".,")) for k, a, b in want] == [(k, text[a:b]) for k, a, b in got], example
    # cutting texts into pieces changes nothing
    texts = [pii.marked(x)[0].split() for x in pii.EXAMPLES] + [[], ["555.867.5309"]]
    starts = np.cumsum([0, *map(len, texts)])
    scores = field.emissions([w for t in texts for w in t], starts[:-1])
    labels = field.decode(scores, starts[:-1])
    for a, b in zip(starts, starts[1:], strict=False):
        s, back = (scores[a].copy() if b > a else None), []
        for t in range(a + 1, b):
            through = s[:, None] + field.pair
            back.append(through.argmax(axis=0))
            s = through.max(axis=0) + scores[t]
        path = [int(s.argmax())] if b > a else []
        for k in back[::-1]:
            path.append(int(k[path[-1]]))
        assert labels[a:b].tolist() == path[::-1]


def test_unseen_sentences():
    field = pii.train()

    def found(text):
        labels = field.decode(field.emissions(text.split(), np.array([0])), np.array([0]))
        return [(k, text[a:b]) for k, a, b in
                pii.added_spans(text, [m.span() for m in re.finditer(r"\S+", text)], labels, pii.base_spans(text))]

    assert found("You can call (415) 555-2671 on Monday.") == [("phone", "(415) 555-2671")]
    assert found("Please write to tom[at]example.org soon.") == [("email", "tom[at]example.org")]
    assert found("A town of 12 schools, 3,450 people and version 2.0.") == []


@pytest.mark.parametrize("text", ["server ip 1.2.3." + "9" * 5000, "my ip is " + "0" * 6000 + "1.2.3.4", "ip: 1.2.3." + "0" * 9000,
                                  "card " + "4" * 5000, "call +" + "5" * 5000, "ip " + "f" * 5000 + "::1"])
def test_numbers_of_any_length(text):
    field = pii.train()
    starts = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    for label in range(len(pii.KINDS) + 1):
        pii.added_spans(text, starts, np.full(len(starts), label), [])
    assert field and all(pii._is(k, w) in (True, False) for k in pii.KINDS for w in text.split())


def test_personal_data_of_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "😀 a@b.co 1.2.3.4"), (-3, "😀 a@b.co 1.2.3.4")], docs.schema)
    both = docs.unionByName(odd).withColumn("spans", F.lit("clash"))
    got = pii.find(both, pii.train()).collect()
    assert len(got) == both.count()
    for r in got:
        mine = [(s.kind, s.start, s.end) for s in r.spans if s.base]
        assert mine == spans(r.row.text)
        for s in r.spans:
            assert s.base or not any(a < s.end and s.start < b for _, a, b in mine)
    assert pii.find(docs.limit(0), pii.train()).count() == 0
