import re

import brute
import pytest
from conftest import pairs
from pyspark.sql import functions as F

from martlake.llm import fmindex, langid, licenses, pii
from martlake.llm.neardup import near_duplicates


def test_passages_against_brute_force(spark, docs, none):
    items = [(1, "alpha0 beta0 gamma0 délta0 alpha1 beta1 gamma1 délta1 alpha2 beta2 gamma2"), (2, "ONE"), (3, None), (4, ""),
             (5, "two words"), (None, "in this note shall limit any other right of either party"), (5, "two words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1 << 20, 40):
        found = fmindex.find_passages(docs, bench, block_bytes=block_bytes, shard_words=5000).select(
            F.col("row.doc_id").alias("doc_id"), "n_words", "spans", "items").collect()
        got = [(r.doc_id, r.n_words, sum(z - a for a, z in zip(r.spans[::2], r.spans[1::2])), len(r["items"])) for r in found]
        want = [(d, n, hit, k) for d, n, hit, k, _, _ in brute.decontamination(
            [(r.doc_id, r.text) for r in docs.collect()], items)]
        assert sorted(got, key=str) == sorted(want, key=str)
    cut = fmindex.remove_passages(docs, bench)
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.where("doc_id IS NOT NULL").collect()}
    assert left[1] is None and left[2] == "" and left[4] == "" and left[12] == "" and left[11] == "12 34 !!"
    assert left[8].startswith("Whereas the parties agree that nothing  hereto".split("  ")[0])
    assert fmindex.find_passages(none, bench).count() == 0
    assert fmindex.find_passages(docs, bench.limit(0)).where(F.size("spans") > 0).count() == 0


def test_fm_index_counts_and_places():
    import numpy as np
    rng = np.random.default_rng(3)
    seq = np.concatenate([rng.integers(0, 5, 400), [0]])
    index = fmindex.FMIndex(seq, 4)
    for n in (1, 2, 3, 6):
        phrase = rng.integers(1, 5, (30, n))
        low, high = index.search(phrase, np.full(30, n))
        for p, a, z in zip(phrase, low, high):
            want = [k for k in range(len(seq) - n) if (seq[k:k + n] == p).all()]
            assert sorted(index.locate(np.arange(a, max(a, z))).tolist()) == want


def test_near_duplicates_against_brute_force(spark, docs):
    rng = __import__("random").Random(5)
    base = [[f"w{rng.randrange(4000)}" for _ in range(120)] for _ in range(6)]
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in (None, 7, 12)]
    for k in range(150):
        words = list(base[k % 6])
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(120)] = f"v{rng.randrange(10**6)}"
        rows.append((100 + k, " ".join(words)))
    rows += [(500 + k, "\n".join(base[0]).upper()) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x"))
    want = sorted(brute.near_duplicates(rows))
    assert pairs(near_duplicates(df, 3, 85), "doc_id", "n_shingles", "component_id", "kept") == sorted(want, key=str)


def test_near_duplicates_of_awkward_rows(docs):
    rows = near_duplicates(docs, 3, 85).collect()
    assert len(rows) == docs.count()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert of[1] == of[1][:1] == [(0, 1, True)] and of[2] == [(0, 2, True)] and of[4] == [(1, 4, True)]
    assert of[5] == [(1, 4, False)] and of[8][0][1:] == (6, False) and of[None][0][1:] == (None, True)
    assert [x[1] for x in of[7]] == [6, 6] and of[10][0][1:] == (9, False)


def test_near_duplicates_recall_of_op6():
    from martlake.llm import neardup
    halves = neardup.halves_for(0.85, 3, neardup.RECALL)
    assert halves == 10 and 1 - (1 - (1 - 0.85 ** 3) ** halves) ** 2 < 0.0002


def test_near_duplicates_of_nothing(none):
    assert near_duplicates(none).count() == 0


def test_components(spark):
    from martlake.llm.components import components
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (7, 7)] + [(200, 201 + k) for k in range(30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 90: 90, 95: 90, 100: 90, **{200 + k: 200 for k in range(31)}}


def test_language_of_held_out_texts(spark, sf_dir, docs, none):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(texts.where(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(texts, model).where(langid.held_out(F.col("row.doc_id"))).collect()
    assert len(found) > 30 and sum(r.lang_pred == r.row.lang for r in found) >= 0.97 * len(found)
    assert not any(r.rejected for r in found) and all(0 <= r.score <= 1 for r in found)
    awkward = langid.predict(docs, model).collect()
    assert len(awkward) == docs.count()
    und = {r.row.doc_id for r in awkward if r.lang_pred == "und"}
    assert und == {1, 2, 3, 11} and all(r.rejected and r.score == 0 for r in awkward if r.row.doc_id in und)
    far = spark.createDataFrame([(1, "日本語の文章はここにあります。" * 9)], "doc_id long, text string")
    assert langid.predict(far, model).first().rejected
    assert langid.predict(none, model).count() == 0
    nothing = langid.fit(none)
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_language_reads_only_training_rows(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    spoiled = texts.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    assert "zz" not in langid.fit(spoiled.where(~langid.held_out(F.col("doc_id")))).langs


PERSONAL = ["", None, "a@b.com_x@y.org me@site.co.uk.", "x@y a@b. @c.d", "1.2.3.4.5.6.7.8 999.1.2.3.4 0001.02.3.255 1.2.3",
            "4111 1111 1111 1111, 4111-1111-1111-1112 5500005555555559 12345678901234567890 4111  1111", "5 6 a7-8",
            "+1 (235) 555-3833 +49-30-1234567) ++12345678 +1 2", "é a@é.com ü+1 555 123 4567", "1111111111111111111111 1.1",
            "a" * 5000 + " " + "1" * 5000 + " x@" + "y." * 800 + "z"]


def test_base_spans_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(PERSONAL)), "doc_id long, text string")
    for r in pii.spans(df).collect():
        want = brute.personal_data(PERSONAL[r.doc_id])
        assert {k: [(x.start, x.end) for x in r[k]] for k in pii.PATTERNS} == want
    assert pii.spans(df.limit(0)).count() == 0


def test_terms_that_disclose_an_entity(spark, docs):
    rows = [(k, f"note {k}: write to Zorbaxel at boss@corp.com, as item{k % 4} says") for k in range(5)]
    rows += [(10 + k, f"note {k}: as the item says, write the letter at home") for k in range(60)]
    rows += [(80 + k, "copied Quuxword near other@corp.com") for k in range(9)]  # one context, many copies
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("marks", F.lit(1)).withColumn("email", F.lit(2))
    found = {r.doc_id: [rows[r.doc_id][1][x.start:x.end] for x in r.term] for r in pii.spans(df).collect() if r.doc_id < 5}
    assert all(x == ["Zorbaxel"] for x in found.values())
    clean = pii.sanitise(df)
    assert clean.columns == df.columns
    text = {r.doc_id: r.text for r in clean.collect()}
    assert text[0] == "note 0: write to  at [EMAIL], as item0 says" and text[12] == rows[7][1]
    assert text[80] == "copied Quuxword near [EMAIL]"
    same = pii.sanitise(docs)
    assert pairs(same, "doc_id", "text") == pairs(docs, "doc_id", "text")


def test_terms_of_an_entity_that_occurs_once(spark):
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}x" for k in range(300)]
    rows = [(k, " ".join(words[(k * 7 + j) % 300] for j in range(12))) for k in range(1500)]
    far = "wabx " * 60
    rows += [(2000, f"Zorbaxel. {far} boss@corp.com {far} ZORBAXEL, Zorbaxels"), (2001, f"{far} twice@corp.com Quuxword"),
             (2002, f"Quuxword {far} twice@corp.com wbbx"), (2003, "Zorbaxels wabx")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = {r.doc_id: [texts[r.doc_id][x.start:x.end] for x in r.term] for r in pii.spans(df).collect() if r.term}
    assert found == {2000: ["Zorbaxel", "ZORBAXEL"], 2001: ["Quuxword"], 2002: ["Quuxword"]}


def corpus_with_planted_terms():
    """Every text has words of its own; some names come back with their entity, one also without it."""
    rng = __import__("random").Random(6)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(500)]

    def text(*more):
        own = ["".join(rng.choice("klmnopqrst") for _ in range(9)) for _ in range(6)]
        words = rng.choices(vocabulary, k=20) + own + list(more)
        rng.shuffle(words)
        return " ".join(words)

    rows, planted = [(k, text()) for k in range(2000)], {}
    for e in range(30):  # a name in two to four texts with its entity
        for _ in range(2 + e % 3):
            rows.append((len(rows), text(f"Xyl{'abcdefghijklmnopqrstuvwxyzäöüß'[e]}wen", f"person{e}@corp.com")))
            planted[rows[-1][0]] = {f"Xyl{'abcdefghijklmnopqrstuvwxyzäöüß'[e]}wen"}
    for _ in range(40):  # entities that stand once, with no name
        rows.append((len(rows), text(f"once{len(rows)}@corp.com")))
    for k in range(50):  # a name that mostly stands with its entity
        rows.append((len(rows), text("Quuxley", *["desk@corp.com"][:k < 40])))
        if k < 40:
            planted[rows[-1][0]] = {"Quuxley"}
    return rows, planted


def marked_by_brute_force(rows):
    """{doc_id: terms} by the docstring's formulas, for texts without copies."""
    from math import comb, log
    words = {d: {w.lower() for w in re.findall("[^\\W\\d_]{3,}", t)} for d, t in rows}
    held = {d: {m.group().lower() for m in re.finditer(brute.BASE[0][1], t)} for d, t in rows}
    forms = {d: {w.lower() for w in re.findall(r"(?<![\w.%+@-])[^\W\d_]{3,}(?![\w]|[A-Za-z0-9._%+-]*@)", t)} for d, t in rows}
    texts, n = {}, len(rows)
    for d, ws in words.items():
        for w in ws:
            texts.setdefault(w, set()).add(d)
    alike, found = {}, {}
    for ds in texts.values():
        alike[len(ds)] = alike.get(len(ds), 0) + 1
    entities = {}
    for d, es in held.items():
        for e in es:
            entities.setdefault(e, set()).add(d)
    for ds in entities.values():
        for w in set().union(*(forms[d] for d in ds)):
            nt, k, ne = len(texts[w]), sum(w in forms[d] for d in ds), len(ds)
            p, z2 = k / nt, pii.Z ** 2
            low = (p + z2 / (2 * nt) - pii.Z * (p * (1 - p) / nt + z2 / (4 * nt * nt)) ** 0.5) / (1 + z2 / nt)
            if 1 + log(low) / log(n / ne) >= pii.GENERALISE:
                ways = -nt * (p * log(p) + ((1 - p) * log(1 - p) if p < 1 else 0))
                assert ways >= log(comb(nt, k)) - 1e-9
                if log(alike[nt]) + ways - k * log(n / ne) <= log(pii.CHANCE):
                    for d in ds:
                        if w in forms[d]:
                            found.setdefault(d, set()).add(w)
    return found


def test_terms_against_brute_force_and_chance(spark):
    rows, planted = corpus_with_planted_terms()
    texts = dict(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: {texts[r.doc_id][x.start:x.end] for x in r.term} for r in pii.spans(df).collect() if r.term}
    assert {d: {w.lower() for w in ws} for d, ws in found.items()} == marked_by_brute_force(rows)
    right = sum(len(found.get(d, set()) & ws) for d, ws in planted.items())
    assert right >= 0.95 * sum(map(len, planted.values())) and right >= 0.95 * sum(map(len, found.values()))
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    last = max(d for d in planted if "Quuxley" in planted[d])
    assert "[NAME]" in clean[last] and "Quuxley" not in clean[last] and "Quuxley" in clean[last + 1]
    first = min(planted)
    assert "Xyl" not in clean[first] and "[NAME]" not in clean[first]


def test_overlapping_kinds_leave_nothing(spark):
    card = next(c for c in (f"1 4111 1111 1111 11{k:02}" for k in range(100)) if brute.luhn(c.replace(" ", "")))
    texts = ["+1 5551234567bob@x.com", f"10.0.0.{card} end", "call +1 5551234567 or a@b.com now"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean == {0: "[PHONE]", 1: "[IP] end", 2: "call [PHONE] or [EMAIL] now"}


def test_licence_families_and_bodies(spark):
    texts = ["Licensed under CC BY-NC-SA 4.0. " + "word " * 30, "Licensed under CC BY-NC-ND 4.0."]
    texts += [f"Copyright someone. {t} The end." for n, t in licenses.TEMPLATES if n in ("ISC", "Zlib", "BSL-1.0", "EPL-2.0", "Unlicense")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted((r.doc_id, r.license) for r in licenses.scan(df).collect())
    assert found == list(enumerate(["CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "ISC", "Zlib", "BSL-1.0", "EPL-2.0", "Unlicense"]))


def test_licences(spark, docs, none):
    apache = licenses.TEMPLATES[1][1]
    words = apache.split()
    texts = ["x y z " * 50 + "Released under the MIT license, " + "q " * 70, apache.replace("compliance", "accordance"),
             " ".join(words[:12]), "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.license): r for r in licenses.scan(df).collect()}
    assert set(found) == {(0, "MIT"), (1, "Apache-2.0"), (2, "Apache-2.0"), (3, "CC-BY-NC-4.0"), (3, "CC-BY-4.0")}
    assert (found[0, "MIT"].first_word, found[0, "MIT"].last_word) == (150, 154)
    assert licenses.scan(docs).count() == 0 and licenses.scan(none).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(df, [("short", "too few words")])
