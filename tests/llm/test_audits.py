"""Whitening, source audit and personal data against plain versions."""

import itertools
import random

import numpy as np
import pytest
from frameyard.llm.personal_data import KINDS, Field, label_probabilities, matches, nodes, pii_scan
from frameyard.llm.source_audit import source_audit
from frameyard.llm.whitening import refine_eigenvectors, whiten

from tests.llm import brute
from tests.llm.test_operators import EDGE, docs

CARD, OTHER = "4111111111111111", "5500005555555559"


def _spectrum(kind, d):
    return {
        "spread": np.linspace(3, 0.1, d), "clusters": np.repeat([5, 1 + 1e-9, 1, 1e-5], d)[::4][:d] + np.arange(d) * 1e-11,
        "equal": np.r_[np.ones(d // 2), np.full(d - d // 2, 0.5)], "one": np.r_[1, np.zeros(d - 1)], "none": np.zeros(d),
    }[kind]


@pytest.mark.parametrize("kind", ["spread", "clusters", "equal", "one", "none"])
@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_refined_eigenvectors(kind, d):
    q = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0]
    a = (q * _spectrum(kind, d)) @ q.T
    a = (a + a.T) / 2
    e, u = refine_eigenvectors(a)
    assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() < 1e-14 and (np.diff(e) <= 0).all()
    assert np.abs(a.astype(np.longdouble) @ u - u * e).max() < 1e-15 * max(1, np.abs(a).max())
    assert np.abs(u.T @ u - np.eye(d)).max() < 1e-14


def test_refinement_tells_close_eigenvalues_apart():
    """A gap of 1e-6, far below float32, costs few digits of double precision only."""
    d = np.diag([2 + 1e-6, 2, 1, 0.5])
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(4, 4)).astype(np.longdouble).astype("f8"))[0]
    u = refine_eigenvectors(q @ d @ q.T)[1]
    assert np.abs(np.abs(np.diag(q.T @ u)) - 1).max() < 1e-9


def _whitened(vectors, k=4):
    x = np.floor(256 * np.array(vectors, "f4").astype("f8")).astype("i8")
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    v = (fit - s / n).T @ (fit - s / n) / n
    e, u = np.linalg.eigh(v)
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ u[:, ::-1][:, :k] / np.sqrt(e[::-1][:k]), e[::-1][:k] / np.trace(v)


def test_whiten_against_plain(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 6)) * [3, 2, 1.5, 1, 0.5, 0.2]).astype("f4").tolist()
    vectors += vectors[:1] * 150  # copies count once
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(5)
    n, deviation, want, explained = _whitened(vectors)
    rows = whiten(df).collect()
    assert len(rows) == 4 * len(vectors) and {r["n"] for r in rows} == {n}
    got = np.zeros((len(vectors), 4))
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[r["vec_id"]] and abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-12 and r["identity_error"] < 1e-12
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < 1e-10


def test_whiten_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, x string, n long, component string, dim int"
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [3e38, 1e30]), (6, [1.0, 2.0]), (6, [1.0, 2.0]), (None, [-3e38, 2.5]), (9, [1.0, 2.0, 3.0]), (10, [0.5, 0.25]), (11, [float("inf"), 0.0])]
    df = spark.createDataFrame([(*r, "x", 1, "c", 2) for r in rows], schema)
    got = whiten(df).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 2), (5, 1), (5, 2), (6, 1), (6, 1), (6, 2), (6, 2), (10, 1), (10, 2)]
    assert {r["deviation"] for r in got} == {None} and all(np.isfinite(r["whitened"]) and r["identity_error"] < 1e-4 for r in got)
    two = whiten(df.where("vec_id in (6, 10)")).collect()
    assert sorted((r["vec_id"], r["component"], r["n"], round(abs(r["whitened"]), 12), r["explained"]) for r in two) == [(6, 1, 2, 1.0, 1.0)] * 2 + [(10, 1, 2, 1.0, 1.0)]
    for empty in (df.where("false"), df.where("vec_id = 6"), df.where("vec_id < 3")):
        assert whiten(empty).collect() == [] and whiten(empty).columns == whiten(df).columns


def _audit(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], "text string, lang string, source string, row long, term string, chunk long, part string").repartition(3)
    return sorted(tuple(r) for r in source_audit(df, **kw).collect())


def test_source_audit_against_plain(spark):
    rng = random.Random(7)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Été", "naïve", "日本", "don't", "a-b,c", "\x1cx\x1d", "THE", "the.", "(the)", "the"]
    rows = [(rng.choice([" ", "\n", "\t \x0b"]).join(rng.choices(words, range(1, len(words) + 1), k=rng.randrange(60))), rng.choice(["en", "en", "fr", None]), rng.choice(["a", "b", "b", "é", "", None])) for _ in range(150)]
    rows += [rows[0]] * 40 + [(None, "en", "silent"), ("", "xx", "p"), (None, "xx", "q"), ("rare words only", "xx", "q"), ("alone", "yy", "z")]
    for least, cells in ((30, 2_000_000), (4, 50), (1, 40)):
        assert _audit(spark, rows, least_docs=least, cells=cells) == brute.source_audit(rows, least)
    assert _audit(spark, rows, least_docs=2, top=3) == brute.source_audit(rows, 2, top=3)


def test_source_audit_counts_documents_of_all_spellings(spark):
    """Six documents have the term, in chunks that fewer have; some documents have several of them."""
    rows = [(t, "en", "s") for t in ("word, word. x", "word. x", "(word x", "WORD x", "word, x", "word; word? x", "x y", "x y")] + [("word", "fr", "s"), ("x", "en", "t")]
    for least in (5, 6, 7):
        assert _audit(spark, rows, least_docs=least) == brute.source_audit(rows, least)


def test_source_audit_empty(spark):
    assert _audit(spark, [("x", "en", "s")])[:1] == [] and source_audit(docs(spark, []).selectExpr("*", "'a' AS lang", "'b' AS source")).collect() == []


PLAIN = [
    "mail a.b+c@mail.example.com, x@y, @z.com a@b.c@d.e; 999.1.2.3.4 1.2.3.4.5.6.7.8 0001.2.3.255 256.1.1.1", f"card {CARD} and 4111-1111-1111-1111 or 4111 1111 1111 1112",
    "+1 (712) 555-9396 +12 +123456789012345678 ++1 234 567 89-", "é日本 +49 (0) 30 123456 x@y.z..", "1" * 40 + " " + "9" * 5000 + ".1.1.1", "a@-.-", "@@@ 1@1.1", "1.2.3.4" * 3,
]


def test_patterns_against_regex():
    rng = random.Random(2)
    texts = [t for _, t in EDGE if t and len(t) < 10_000] + PLAIN
    texts += ["".join(rng.choices("0123456789 .@+-()aB=", [4] * 10 + [3, 4, 2, 2, 2, 1, 1, 2, 1, 1], k=rng.randrange(200))) for _ in range(600)]
    for t in texts:
        assert [m[:3] for m in matches(t) if m[3]] == brute.personal(t), t


def test_nodes_have_the_labels_of_their_matches():
    text = "+1 " + "1.2.3.4 " * 50 + f"{CARD} a@b.cc " * 30  # all within one match of digits, dots and spaces
    found = matches(text)
    starts, ends, _, labels, *_ = nodes(text, found)
    assert len(starts) == 111 and labels == [max((k + 1 for s, k, e, ok in found if ok and s < b and e > a), default=0) for a, b in zip(starts, ends, strict=True)]


def test_patterns_stay_linear():
    for t in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "1 " * 200_000, "+1" * 200_000, "a@" * 200_000, "a@b" * 100_000, "(" * 400_000):
        nodes(t, matches(t))


def _pii(spark, rows, **kw):
    return {r["doc_id"]: r for r in pii_scan(docs(spark, rows), **kw).collect()}


def _examples():
    """Texts with plain cases and with numbers that are none, as a corpus has them."""
    rng = random.Random(9)
    out = []
    for i in range(60):
        out += [(1000 + 4 * i, f"the {CARD} of {i}."), (1001 + 4 * i, f"to +1 ({200 + i}) 555-{1000 + i} or 10.0.{i}.7 and q{i}.{i}@mail{i}.example.com"),
                (1002 + 4 * i, f"in {1900 + i} a{i} {i}.{i}. password={rng.getrandbits(64):x} {i}%"), (1003 + 4 * i, f"code {4000000000000000 + 20 * i + 1} and 12{i}, or +44 555-{2000 + i} then +44 555-{2000 + i}")]
    return out


def test_pii_scan_base_and_edges(spark):
    rows = EDGE + [(100 + i, t) for i, t in enumerate(PLAIN)] + _examples()
    df = docs(spark, rows).repartition(3)
    got = sorted(((r["doc_id"] or 0, *(r[f"n_{k}"] for k in KINDS), *((s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"])) for r in pii_scan(df).collect()), key=str)
    want = []
    for i, t in rows:
        found = brute.personal(t)
        want.append((i or 0, *(sum(k == f[1] for f in found) for k in range(4)), *((KINDS[k], a, b) for a, k, b in found)))
    assert got == sorted(want, key=str)
    assert pii_scan(docs(spark, [])).collect() == [] and _pii(spark, [(1, "plain words"), (2, None)])[1]["spans"] == []


def test_pii_scan_adds_what_patterns_miss_and_leaves_clean_texts_alone(spark):
    rows = _examples() + [(1, f"at 10.0.0.61 {OTHER} end"), (2, f"both {CARD} {OTHER} x"), (3, "in 1999 some 12 of 300, 4.5. and ab12 4000000000000001"), (4, "ring 555-9396 now"), (5, "at +44 555-9396 " + "or so " * 300 + "ring 555-9396 now")]
    got = _pii(spark, rows)
    added = {i: [(s["kind"], rows_text[s["start"] : s["end"]]) for s in got[i]["spans"] if not s["base"]] for i, rows_text in rows if i < 10}
    assert added[1] == [("card", OTHER)] and added[2] == [("card", CARD), ("card", OTHER)] and added[3] == []
    assert added[4] == [] and added[5] == [("phone", "555-9396")]  # the first mention speaks for the second
    assert not any(not s["base"] for i, r in got.items() if i >= 1000 for s in r["spans"])


def _graph(text):
    parts = nodes(text, matches(text))
    return [np.array(parts[i]) for i in (2, 3)] + [np.array(parts[4]), np.array(parts[5]), np.array(parts[6])]


def _random_field(seed):
    rng, field = np.random.default_rng(seed), Field()
    field.unary, field.chain, field.skip = rng.normal(size=field.unary.shape), rng.normal(size=(6, 6)), rng.uniform(0, 2, (2, 5))
    return field


def test_message_passing_is_exact_on_trees():
    text = "12 345 +1 (712) 555-9396 and ab99, far away 4000000000000001 then ab99 4.5"
    shapes, labels, near, skips, same = _graph(text)
    field = _random_field(1)
    got = label_probabilities(field, shapes, labels, near, skips, same)
    n, total = len(shapes), np.zeros((len(shapes), 5))
    unary = field.nodes(shapes)
    for y in itertools.product(*([int(k)] if k else range(5) for k in labels)):
        score = sum(unary[i, y[i]] + (field.chain[y[i - 1], y[i]] if near[i] else 0) for i in range(n))
        score += sum(field.skip[int(same[i]), y[i]] for i in range(n) if skips[i] >= 0 and y[skips[i]] == y[i])
        total[np.arange(n), y] += np.exp(score)
    assert skips.max() >= 0 and labels.max() > 0 and np.abs(got - total / total.sum(1, keepdims=True)).max() < 1e-9


def test_distant_repeats_share_evidence_and_documents_do_not():
    field = Field()
    field.skip[:] = 6.0
    text = f"ab {CARD} x " + "word " * 500 + f"1{CARD} y"  # similar: same last digits
    shapes, labels, near, skips, same = _graph(text)
    alone = label_probabilities(field, shapes, labels, near, np.full_like(skips, -1), same)
    linked = label_probabilities(field, shapes, labels, near, skips, same)
    assert labels.tolist() == [3, 0] and alone[1].argmax() == 0 and linked[1].argmax() == 3
    two = [np.concatenate([a, a]) for a in (shapes, labels, near, skips, same)]
    two[3][2:] = np.where(two[3][2:] >= 0, two[3][2:] + 2, -1)
    assert np.abs(label_probabilities(field, *two)[2:] - linked).max() < 1e-12


