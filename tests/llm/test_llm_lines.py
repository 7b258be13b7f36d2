import random

import pytest
from pyspark.sql import functions as F

from ratewatch.llm import line_dedup
from ratewatch.session import shared_folder
from test_llm_components import by_search


def grams(line, n=5):
    return {line[i : i + n] for i in range(len(line) - n + 1)} or {line}


def alike(a, b):
    one, two = grams(a), grams(b)
    return 5 * len(one & two) >= 4 * len(one | two)


def edited(line, rng, edits):
    words = line.split()
    for k in rng.sample(range(len(words)), edits):
        words[k] = f"new{rng.randrange(99)}"
    return " ".join(words)


def test_links_are_those_of_all_pairs(make_docs, prose):
    rng = random.Random(2)
    lines = [prose(k, rng.randint(3, 60)) for k in range(150)]
    lines += [edited(x, rng, rng.choice([1, 1, 2, 3])) for x in lines[:90] if len(x.split()) > 8]
    docs = make_docs(*enumerate(lines))
    links = [(a, b) for i, a in enumerate(lines) for b in lines[:i] if a != b and alike(a, b)]
    found = line_dedup.line_links(line_dedup.lines_of(docs))
    names = {r.same: r.line for r in line_dedup.lines_of(docs).select("same", "line").collect()}
    got = {frozenset((names[bytes(r.a)], names[bytes(r.b)])) for r in found.collect()}
    wanted = {frozenset(x) for x in links}
    assert got <= wanted
    assert len(got) >= 0.98 * len(wanted) > 30


def classes(docs):
    return {r.doc_id: bytes(r["class"]) for r in line_dedup.line_classes(docs).collect()}


def test_pairs_among_lines_that_share_a_passage(make_docs, prose, monkeypatch):
    monkeypatch.setattr(line_dedup, "FEW", 16)
    rng = random.Random(5)
    passage = prose(1, 60)
    one = [f"{passage} {prose(100 + k, 12)}" for k in range(200)]
    two = [edited(x, rng, 4) for x in one]
    pairs = [(k, k + 200) for k in range(200) if alike(one[k], two[k])]
    assert len(pairs) > 150 and not any(alike(one[k], one[0]) for k in range(1, 200))
    found = classes(make_docs(*enumerate(one + two)))
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.98 * len(pairs)
    assert len(set(found.values())) >= 200


def test_one_line_of_a_class_stays(make_docs, prose):
    rng = random.Random(7)
    shared = prose(1, 40)
    chain = [shared]
    for _ in range(5):
        chain.append(edited(chain[-1], rng, 1))
    docs = make_docs(
        (3, f"{shared}\nthree of its own kind"),
        (1, f"{chain[1]}\n\nfirst\n \nfirst"),
        (2, f"{chain[2]}\n{chain[4]}\n{chain[5]}\nfirst"),
        (4, None),
        (5, ""),
        (6, "first"),
        (7, chain[3]),
        (8, " \n"),
    )
    got = {r.doc_id: r.text for r in line_dedup.drop_lines(docs).collect()}
    assert got == {1: f"{chain[1]}\n\nfirst\n ", 2: "", 3: "three of its own kind", 4: None, 5: "", 6: "", 7: "", 8: " \n"}


def test_columns_nulls_and_repeats(make_docs, prose):
    text = "one line here\nanother line there\none line here"
    docs = make_docs((None, text), (1, text), (1, text)).withColumnRenamed("lang", "kept").withColumn("line", F.lit(1))
    got = line_dedup.drop_lines(docs)
    assert got.columns == docs.columns
    rows = [(r.doc_id, r.text, r.n_chars) for r in got.collect()]
    first = "one line here\nanother line there"
    assert sorted(rows, key=str) == sorted([(None, "", 0), (1, first, len(first)), (1, first, len(first))], key=str)
    assert line_dedup.drop_lines(make_docs()).count() == 0


def test_long_lines_and_odd_characters(make_docs, prose):
    long = prose(3, 9000)
    docs = make_docs((1, long), (2, long + " end"), (3, "😀 a b 😀😀😀😀😀"), (4, "😀 a b 😀😀😀😀😀"), (5, "x\ty\r"))
    got = {r.doc_id: r.text for r in line_dedup.drop_lines(docs).collect()}
    assert got == {1: long, 2: "", 3: "😀 a b 😀😀😀😀😀", 4: "", 5: "x\ty\r"}


def test_no_python_in_the_plan(make_docs):
    plan = line_dedup.drop_lines(make_docs((1, "a b"), (2, "a b")))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


def test_short_and_unspaced_lines(make_docs, spark):
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def word(n):
        return "".join(rng.choice(letters) for _ in range(n))

    def changed(line, at):
        return f"{line[:at]}{'0' if line[at] != '0' else '1'}{line[at + 1 :]}"

    one = [" ".join(word(rng.randint(6, 14)) for _ in range(n)) for n in (2, 3, 4, 5, 6, 8, 10, 12) for _ in range(40)]
    short = [(x, changed(x, rng.choice([0, 1, 2, len(x) - 1, rng.randrange(len(x))]))) for x in one]
    short = [(a, b) for a, b in short if alike(a, b)]
    whole = [word(200) for _ in range(60)]
    unspaced = [(x, changed(x, rng.randrange(12))) for x in whole]
    pairs = short + unspaced
    assert len(short) > 150 and all(alike(a, b) for a, b in unspaced)
    lines = [x for pair in pairs for x in pair]
    found = classes(make_docs(*enumerate(lines)))
    for some in (range(len(short)), range(len(short), len(pairs))):
        assert sum(found[2 * k] == found[2 * k + 1] for k in some) >= 0.98 * len(some)


def test_lines_that_all_share_a_bucket_are_compared_with_few(make_docs, prose, monkeypatch):
    """Lines with one long passage, all different: each is paired with far less than 100 others."""
    monkeypatch.setattr(line_dedup, "FEW", 16)
    passage = prose(1, 50)
    lines = line_dedup.lines_of(make_docs(*enumerate(f"{passage} {prose(100 + k, 20)}" for k in range(600))))
    found = line_dedup.members(line_dedup.signatures(lines)).persist()
    groups = lines.select(F.col("same").alias("node"), F.col("same").alias("component")).where("false")
    rows = line_dedup.mixed(found, groups)
    _, apart = line_dedup.standing(rows)
    assert apart.agg(F.max("m")).first()[0] > 200
    assert line_dedup.few_pairs(apart, F.lit(True)).count() < 100 * 600
    pairs = line_dedup.further_pairs(lines, rows, apart, groups)
    assert pairs.count() < 100 * 600 and line_dedup.verified(lines, pairs).count() == 0


def test_a_line_with_very_many_pairs_is_dealt(make_docs, prose, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARE", 8)
    base = prose(1, 40)
    lines = [base, *(f"{base} {k:02d}" for k in range(40))]
    found = classes(make_docs(*enumerate(lines)))
    assert len(set(found.values())) == 1


def test_places_are_gathered_once_for_all_copies(make_docs, prose):
    text = "\n".join(prose(k, 12) for k in range(30))
    docs = make_docs((1, text), *[(2, text)] * 50, *[(None, text)] * 50)
    got = line_dedup.drop_lines(docs)
    assert {(r.doc_id, r.text) for r in got.collect()} == {(1, text), (2, ""), (None, "")} and got.count() == 101


def test_what_is_left_behind_is_small(spark, make_docs, prose):
    from pathlib import Path

    folder = Path(shared_folder(spark), "ratewatch")
    before = set(folder.glob("*"))
    line_dedup.drop_lines(make_docs(*[(k, prose(k % 20, 30)) for k in range(60)])).collect()
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before}
    assert left and not left & {"members", "mixed", "standing", "texts", "pairs", "further", "sized", "keyed", "shared"}


@pytest.mark.parametrize("few", [16, 256])
def test_every_line_of_a_component_is_compared(make_docs, monkeypatch, few):
    """A hundred similar lines, and with each one another that is similar to it alone."""
    monkeypatch.setattr(line_dedup, "FEW", few)
    rng = random.Random(13)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(n)]

    base = words(100)
    one = [base[:92] + words(8) for _ in range(100)]
    two = [words(8) + x[8:] for x in one]
    one, two = ([" ".join(x) for x in some] for some in (one, two))
    assert all(alike(a, one[0]) and alike(a, b) for a, b in zip(one, two, strict=True))
    assert not any(alike(two[0], x) for x in one[1:] + two[1:])
    found = classes(make_docs(*enumerate(one + two)))
    assert sum(found[k] == found[0] for k in range(100)) == 100
    assert sum(found[k] == found[0] for k in range(100, 200)) >= 98


def test_large_buckets_lose_no_pair(make_docs, prose, monkeypatch):
    """Lines of one bucket that share a passage; every similar pair of two components is given."""
    monkeypatch.setattr(line_dedup, "FEW", 16)
    rng = random.Random(17)
    passage = prose(1, 40)
    texts = [f"{passage} {prose(100 + k, 12)}" for k in range(80)]
    texts += [edited(x, rng, rng.choice([1, 2, 3, 4])) for x in texts[:60]]
    lines = line_dedup.lines_of(make_docs(*enumerate(texts)))
    rows = line_dedup.signatures(lines).select(
        F.lit(1).alias("key"),
        F.when(F.col("near") % 3 == 0, F.lit("one").cast("binary")).otherwise(F.col("same")).alias("component"),
        F.struct("near", "same").alias("line"),
        line_dedup.sketch().alias("sketch"),
    )
    _, apart = line_dedup.standing(rows)
    found = line_dedup.many_pairs(lines.select("near", "same", "line"), apart)
    got = {frozenset((bytes(r.a), bytes(r.b))) for r in found.collect()}
    whole = lines.select("near", "same", "line").collect()
    parts = [("one" if r.near % 3 == 0 else bytes(r.same), bytes(r.same), r.line) for r in whole]
    pairs = [(x, y) for k, x in enumerate(parts) for y in parts[:k] if x[0] != y[0]]
    wanted = {frozenset((x[1], y[1])) for x, y in pairs if alike(x[2], y[2])}
    assert wanted <= got and len(wanted) > 30 and len(got) < len(pairs) / 4


def test_similar_lines_are_listed_once_in_finer_buckets(make_docs, prose, monkeypatch):
    """Lines of two families: a similar pair is listed once by its rarest shingles, and few others are."""
    monkeypatch.setattr(line_dedup, "FEW", 16)
    rng = random.Random(19)
    texts = [edited(x, rng, rng.choice([2, 4, 7])) for x in (prose(1, 50), prose(2, 50)) for _ in range(60)]
    lines = line_dedup.lines_of(make_docs(*enumerate(texts)))
    rows = line_dedup.signatures(lines).select(
        F.explode(F.array(F.lit(1).cast("long"), F.lit(2) + F.col("near") % 2)).alias("key"),
        F.col("same").alias("component"),
        F.struct("near", "same").alias("line"),
        line_dedup.sketch().alias("sketch"),
    )
    _, apart = line_dedup.standing(rows)
    assert line_dedup.clusters(apart).agg(F.countDistinct("cluster"), F.count("*")).first()[:] == (1, len(set(texts)))
    listed = []
    keep = line_dedup.stored

    def stored(df, name):
        out = keep(df, name)
        if name == "ends" and "id2" in out.columns:
            listed.extend((r.id, r.id2) for r in out.collect())
        return out

    monkeypatch.setattr(line_dedup, "stored", stored)
    found = line_dedup.many_pairs(lines.select("near", "same", "line"), apart).collect()
    wanted = {frozenset((a, b)) for k, a in enumerate(texts) for b in texts[:k] if a != b and alike(a, b)}
    names = {r.same: r.line for r in lines.select("same", "line").collect()}
    assert wanted <= {frozenset((names[bytes(r.a)], names[bytes(r.b)])) for r in found}
    assert len(wanted) > 20 and len(listed) == len(set(listed))


def test_unlike_lines_of_few_words_seldom_share_a_band(make_docs):
    """Long lines of one small vocabulary share a fifth of their shingles, and hardly a band."""
    rng = random.Random(23)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(150)]
    texts = [" ".join(rng.choices(words, k=160)) for _ in range(200)]
    ones = [grams(x) for x in texts[:40]]
    shares = [len(a & b) / len(a | b) for k, a in enumerate(ones) for b in ones[:k]]
    assert 0.15 < sum(shares) / len(shares) < 0.3
    lines = line_dedup.lines_of(make_docs(*enumerate(texts)))
    found = line_dedup.members(line_dedup.signatures(lines))
    assert found.where("n > 4").count() < 20


def test_similar_lines_meet_in_a_band():
    """Minima of lines that share 0.8 and 0.85 of their shingles agree with that probability."""
    rng = random.Random(29)
    for share, most in ((0.8, 0.0045), (0.85, 0.001)):
        same = [{k for k in range(line_dedup.HASHES * line_dedup.ROWS) if rng.random() < share} for _ in range(20_000)]
        assert sum(not any(same_set.issuperset(x) for x in line_dedup.SETS) for same_set in same) < most * len(same)


def test_signatures_take_in_every_shingle(make_docs, prose):
    """Minima are those of all shingles for lines of any length, and copies are counted."""
    text = prose(31, 40)
    texts = [text[-n:] for n in range(1, 70)] + [text]
    lines = line_dedup.lines_of(make_docs(*enumerate(texts + texts[::2])))
    orders = [(b, r) for b in (1, line_dedup.HASHES - 1) for r in (0, line_dedup.ROWS - 1)]

    def least(b, r):
        bits, mask = 64 // line_dedup.TURNS * (b % line_dedup.TURNS), F.lit(line_dedup.MASKS[r])
        ordered = F.transform(
            line_dedup.shingles("line"),
            lambda h: line_dedup._turned(F.xxhash64(F.lit(b // line_dedup.TURNS), h), bits).bitwiseXOR(mask),
        )
        return F.array_min(ordered).alias(f"s{b * line_dedup.ROWS + r}")

    wanted = lines.groupBy("near", "same", "line").agg(F.count("*").alias("copies"))
    wanted = wanted.select("near", "same", "copies", *[least(b, r) for b, r in orders])
    found = line_dedup.signatures(lines).select(wanted.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert found.count() == len({x for x in texts if x.strip()})


def test_texts_of_other_lines_are_not_shuffled(spark):
    """All rows that are wanted stay, and hardly any other one."""
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("near"))
    wanted = rows.where("id % 100 = 0")
    found = {r.id for r in line_dedup.marked(rows, wanted.select("near")).collect()}
    assert found.issuperset(range(0, 20_000, 100)) and len(found) < 250
