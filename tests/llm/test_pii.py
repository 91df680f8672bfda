import hashlib
import random
import re

import numpy as np
import pytest

from gatewatch.llm import bilstm_crf as net
from gatewatch.llm import pii
from gatewatch.llm.common import table

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = [True, all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else True,
                  16 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0,
                  8 <= len(digits) <= 15][kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_equals_patterns_on_random_texts():
    rng = random.Random(2)
    pieces = list("0123456789") + ["@", ".", "-", "+", " ", "(", ")", "a", "Z", "é", "\n", "4111111111111111", "255", "+1 (968) 555-9369", "a@b.c", "..", "@@"]
    for _ in range(4000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 30)))
        assert pii.base_spans(text) == brute(text), text


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v + 0.3 * rng.standard_normal(v.shape) for k, v in net.new_params(6, 3, 4, 5, dtype=np.float64).items()}
    rows = [rng.integers(1, 6, n) for n in (7, 4, 1)]
    tags = [rng.integers(0, 3, len(r)) for r in rows]
    c, m = net.padded(rows)
    t, _ = net.padded(tags)
    _, g = net.loss_and_gradients(p, c, m, t)
    for k, v in p.items():
        for at in rng.choice(v.size, min(6, v.size), replace=False):
            i = np.unravel_index(at, v.shape)
            v[i] += 1e-5
            up, _ = net.loss_and_gradients(p, c, m, t)
            v[i] -= 2e-5
            down, _ = net.loss_and_gradients(p, c, m, t)
            v[i] += 1e-5
            assert abs((up - down) / 2e-5 - g[k][i]) < 1e-6, k


def test_viterbi_equals_brute_force():
    import itertools
    rng = np.random.default_rng(1)
    p = {k: v + rng.standard_normal(v.shape) for k, v in net.new_params(6, 3, 4, 5, dtype=np.float64).items()}
    rows = [rng.integers(1, 6, n) for n in (5, 3, 1)]
    for row, (path, _) in zip(rows, net.decode(p, rows), strict=True):
        c, m = net.padded([row])
        e = net.emissions(p, c, m)[0][:, 0]
        best = max(itertools.product(range(3), repeat=len(row)), key=lambda y: p["S"][y[0]] + p["F"][y[-1]] + sum(
            e[i][y[i]] for i in range(len(y))) + sum(p["T"][a, b] for a, b in zip(y, y[1:], strict=False)))
        assert tuple(path) == best


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(table(spark, "/root/testdata/sf0.01", "documents"))


def test_model_on_held_out_spans(model):
    good = total = found = 0
    for text, want in pii.made_examples(seed=99, n=300):
        (path, lead), = net.decode(model, [pii.char_codes(text)])
        got = {s[:3] for s in pii.spans_of(path, lead)}
        good += len(got & set(want))
        total += len(want)
        found += len(got)
    assert good / total > 0.85 and good / found > 0.85


def test_query_base_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    got = {r.doc_id: r for r in pii.op5_pii(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        want = brute(text)
        text_of = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in want)
        assert got[i].base_sha256 == hashlib.sha256(text_of.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == j for s in want) for j in range(4)]
        assert set(text_of.split(",")) - {""} <= set(got[i].spans.split(","))


def test_windows_cover_all_triggers_and_overlap():
    text = "x" * 50 + "1" * 1000 + "y" * 300 + "@" + "z" * 10
    ws = pii.windows(text)
    assert all(any(a <= i < b for a, b in ws) for i, c in enumerate(text) if c in "1@")
    assert all(b - a <= pii.WINDOW for a, b in ws)
    run = [w for w in ws if w[0] < 1000]
    assert all(x[1] - y[0] >= pii.OVERLAP for x, y in zip(run, run[1:], strict=False))
    assert pii.windows("no digits") == []


def test_odd_rows_and_redaction(spark, model):
    rows = [(1, None, None, "s"), (2, "", 0, "s"), (3, "mail a.b@c.de now", 17, "s"), (None, "+1 (968) 555-9369", 17, None),
            (3, "mail a.b@c.de now", 17, "s"), (4, "é" * 40_000 + " 10.0.0.1", 40_009, "s"), (5, "9" * 60_000, 60_000, "s"),
            (6, "x" * 60_000 + "@", 60_001, "s"), (7, "clean text only", 15, "s"), (8, "1.2.3.4@x.yz", 12, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    assert pii.private_spans(docs, model).count() == len(rows)
    assert pii.private_spans(docs.limit(0), model).count() == 0
    out = pii.redact(docs)
    assert out.schema == docs.schema
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text is None and got[2].text == "" and got[3].text == "mail [EMAIL] now" and got[3].n_chars == 16
    assert got[None].text == "[PHONE]" and got[4].text == "é" * 40_000 + " [IP]" and got[7].text == "clean text only"
    assert got[8].text == "[EMAIL]"


LONG = ["margaret.hollingsworth.jr @ example.org", "jo @ department.university-hospital.example.org", "jane (at) example (dot) org",
        "christopher.montgomery-whitfield @ archaeology.northern-university.example.net"]


def test_long_and_written_out_emails(spark, model):
    rows = [(i, f"please write to {mail} for the results") for i, mail in enumerate(LONG)] + [(9, "we meet (at) noon")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.private_spans(docs, model).collect()}
    assert got == {i: [(0, 16, 16 + len(mail))] for i, mail in enumerate(LONG)} | {9: []}


def test_windows_hold_whole_addresses():
    rng = random.Random(4)
    for _ in range(500):
        text, (a, b) = "", (0, 0)
        for _ in range(rng.randint(1, 4)):
            name, site = ("".join(rng.choices("ab.-_7", k=rng.randint(1, n))) for n in (64, 200))
            mail = "n" + name + rng.choice([" @ ", "(at)", " [at] ", "@ "]) + "d" + re.sub("[^ab7]", "-", site) + rng.choice([".", " (dot) "]) + "org"
            text += "w " * rng.randint(0, 40) + "5" * rng.choice([0, 0, 300]) + " "
            a, b = len(text), len(text) + len(mail)
            text += mail + " "
            ws = pii.windows(text + "w " * 30)
            assert any((lo < a or lo == 0) and b < hi for lo, hi in ws), text
    assert max(b - a for a, b in pii.windows("x" * 50_000 + " @ b.c" * 3)) < 2 * pii.REACH + 100


def test_held_out_long_examples(model):
    good = total = found = 0
    for text, want in pii.long_examples(seed=98, n=300):
        (path, lead), = net.decode(model, [pii.char_codes(text)])
        got = {s[:3] for s in pii.spans_of(path, lead)}
        good += len(got & set(want))
        total += len(want)
        found += len(got)
    assert good / total > 0.85 and good / found > 0.85


def test_dotted_run_with_a_very_long_part(spark, model):
    text = "0" * 5000 + "1.2.3.4"
    assert pii.base_spans(text) == [(1, 0, len(text))]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [(s.kind, s.start, s.end) for s in pii.private_spans(docs, model).first().spans if s.kind == 1] == [(1, 0, len(text))]


def test_held_out_secrets_ids_and_names(model):
    good, total, found = ([0] * len(pii.KINDS) for _ in range(3))
    for text, want in pii.secret_examples(seed=97, n=500):
        (path, lead), = net.decode(model, [pii.char_codes(text)])
        got = {s[:3] for s in pii.spans_of(path, lead)}
        for k in (4, 5, 6):
            good[k] += sum(s[0] == k for s in got & set(want))
            total[k] += sum(s[0] == k for s in want)
            found[k] += sum(s[0] == k for s in got)
    for k in (4, 5, 6):
        assert good[k] / total[k] > 0.85 and good[k] / found[k] > 0.85, pii.KINDS[k]


def test_the_model_adds_the_secrets_of_the_table(spark):
    """Added spans on the whole table: every one is a key that stands there, and
    nearly every key is found."""
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    keys = {(i, a, b) for i, t in docs.items() for _, a, b in pii.known_keys(t)}
    added = set()
    for r in pii.op5_pii(spark, sf).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert r.n_spans == len(spans) and r.n_secret == sum(s[0] == "secret" for s in spans)
        base = {tuple(s) for s in ((pii.BASE_KINDS[k], str(a), str(b)) for k, a, b in pii.base_spans(docs[r.doc_id]))}
        added |= {(r.doc_id, s[0], int(s[1]), int(s[2])) for s in spans if tuple(s) not in base}
    found = {(i, a, b) for i, kind, a, b in added if kind == "secret"}
    assert len(keys) >= 10 and len(found & keys) >= 0.9 * len(keys) and len(found & keys) >= 0.9 * len(added)


def test_reconciled_spans_equal_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choices("ab1 .+@-", k=80))
        spans = [(rng.randint(0, 6), a, a + rng.randint(1, 12), rng.random(), 0, 80) for a in rng.choices(range(68), k=40)]
        spans += [(4, 3, 13, 0.5, 0, 80)] if rng.random() < 0.5 else []
        text = text[:3] + "abcdef1234" + text[13:]
        base = [(0, a, a + rng.randint(1, 9)) for a in rng.choices(range(70), k=rng.randint(0, 3))]
        taken, want = [(a, b) for _, a, b in base], []
        for _, k, a, b in sorted({(s, k, a, b) for k, a, b, s, _, _ in spans}, key=lambda w: (-w[0], w[1:])):
            named = k != 6 or pii.BEFORE_NAME.search(text[:a])
            if pii.plausible(k, text[a:b]) and named and all(b <= x or y <= a for x, y in taken):
                taken.append((a, b))
                want.append((k, a, b))
        assert pii.reconcile(text, spans, base) == want


def test_very_long_texts_take_time_in_proportion(spark, model):
    import time

    many = "call 555 123 4567 or a.b @ c.org key=9f8e7d6c5b4a39281706f5e4d3c2b1a0 " * 15_000  # 1 MB
    docs = spark.createDataFrame([(1, many), (2, "1.2.3.4 " * 125_000), (3, "token " * 160_000)], "doc_id long, text string").repartition(3)
    t0 = time.time()
    got = {r.id: r for r in pii.private_spans(docs, model, redacted=True).collect()}
    assert time.time() - t0 < 240
    assert sum(s.kind == 4 for s in got[1].spans) >= 14_000 and "[SECRET]" in got[1].redacted
    assert len(got[2].spans) == 125_000 and got[2].redacted == "[IP] " * 125_000 and got[3].redacted is None
    text = "7" * 400_000
    found = [(2, 10 * i, 10 * i + 16, float(i % 97), 0, len(text)) for i in range(40_000)]
    t0 = time.time()
    pii.reconcile(text, found, [(1, 20 * i, 20 * i + 3) for i in range(20_000)])
    assert time.time() - t0 < 5
