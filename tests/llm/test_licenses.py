import random

from gatewatch.llm import licenses as lic
from gatewatch.llm.common import alnum_words

from .helpers import same_rows


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert same_rows(lic.op2_license_scan(spark, sf), lic.op2_sql(), sf) == 1000


def brute(text, templates, stride=32):
    words = [w.decode() for w in alnum_words((text or "").encode())]
    out = []
    for s in range(0, len(words), stride):
        block = set(words[s:s + 2 * stride])
        before = len(out)
        for k, t in enumerate(templates):
            want = set(t.words)
            if want and len(block & want) >= t.threshold * len(want) - 1e-9 and block & want and set(t.required.split()) <= block:
                places = [p for p in range(s, min(s + stride, len(words))) if words[p:p + len(t.words)] == t.words] if t.exact else []
                out.append((k, s, min(s + 2 * stride, len(words)), len(block & want) / len(want), places))
        own = out[before:]
        out[before:] = [m for m in own if not any(templates[m[0]].outdone_by(templates[x[0]]) for x in own)]
    return len(words), sorted(out)


def test_blocks_equal_brute_force(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(30)]
    templates = tuple(lic.Template(f"l{i}", " ".join(rng.choices(vocab, k=rng.randint(1, 20))), rng.choice([.3, .5, .8, 1.0]), i % 3 == 0,
                                   family=rng.choice(["", "f", "g"]) if i % 3 else "", required=" ".join(rng.sample(vocab[:4], rng.randint(0, 2))) if i % 3 else "")
                      for i in range(20))
    texts = [" ".join(rng.choices(vocab + [f"x{i}" for i in range(60)], k=rng.randint(0, 200))) for _ in range(30)]
    texts += [None, "", "W1.w2", "é" * 40_000, templates[0].text + "\n" + templates[3].text, texts[0]]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "w1", 1)], "doc_id long, text string, matches int")
    got = {r.id: (r.n_words, sorted((m.template, m.start, m.end, m.containment, m.places) for m in r.matches))
           for r in lic.license_blocks(docs, templates).collect()}
    assert got == {i: brute(t, templates) for i, t in enumerate(texts)} | {None: brute("w1", templates)}
    assert lic.license_blocks(docs.limit(0), templates).count() == 0


def test_phrase_over_lines_and_long_texts(spark):
    text = "x " * 31 + "MIT\n\nLicense" + " y" * 50_000 + " general-public/LICENSE mit license"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (r,) = lic.license_blocks(docs).collect()
    places = sorted((m.label, p) for m in r.matches for p in m.places)
    assert places == [("gpl", 50_033), ("mit", 31), ("mit", 50_036)]


def test_the_most_specific_license_wins(spark):
    texts = {
        "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "cc-by-nc": "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "cc-by-sa": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "cc-by-nd": "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
        "cc-by-nc-sa": "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
        "cc-by-nc-nd": "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
        "agpl,gpl": next(t.text for t in lic.NOTICES if t.label == "agpl"),
        "gpl,lgpl": next(t.text for t in lic.NOTICES if t.label == "lgpl"),  # the base phrase stays
        "gpl": next(t.text for t in lic.NOTICES if t.label == "gpl"),
        "cc-by-nc ": "All figures: licensed under CC BY-NC 4.0", "cc-by-nc-nd ": "licensed under CC BY-NC-ND 4.0", "cc-by ": "licensed under CC BY 4.0",
        "isc": next(t.text for t in lic.NOTICES if t.label == "isc"), "": "We bought a license in the creative quarter.",
    }
    docs = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    got = {r.id: ",".join(sorted({m.label for m in r.matches if m.template >= len(lic.BASE) or m.places})) for r in lic.license_blocks(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [k.strip() for k in texts]
