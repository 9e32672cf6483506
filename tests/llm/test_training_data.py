from __future__ import annotations

import json
import random
import re
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import catalog
from siltworks.llm import p01_groups as p1
from siltworks.llm import p02_repetition as p2
from siltworks.llm import p03_survivors as p3
from siltworks.llm import p04_pairs as p4
from siltworks.llm import p05_history as p5
from siltworks.llm import p06_markup as p6
from siltworks.llm import p07_leakage as p7
from siltworks.llm import p08_mixing as p8
from siltworks.llm import p09_shared_spans as p9

PAIRS = "left_id string, right_id string, similarity double"
NAN = float("nan")


def rows(df):
    return {tuple(r) for r in df.collect()}


def extra(df):
    """Columns whose names clash with what operators use inside, and one of an odd type."""
    for c in ("a", "b", "v", "to", "root", "doc", "key", "cls", "n", "slot", "tid", "rep", "tier", "class", "source_", "_salt"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("clash"))
    return df.withColumn("odd", F.create_map(F.lit("k"), F.lit(1)))


# ---- 1 ----


def union_find(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b, s in pairs:
        if a is not None and b is not None and s is not None and s == s and s >= 0.8 and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {(min(r for r in parent if find(r) == find(v)), v) for v in parent}


def test_groups_of_chains_stars_and_dirt(spark):
    r = random.Random(5)
    pairs = [(f"c{i:03d}", f"c{i + 1:03d}", 0.9) for i in range(60)] + [("hub", f"h{i}", 1.0) for i in range(80)] + [(f"h{i}", "hub", 0.8) for i in range(5)]
    pairs += [("x", "x", 1.0), (None, "x", 1.0), ("y", None, 1.0), ("y", "z", None), ("y", "z", NAN), ("y", "z", 0.79)]
    pairs += [(f"r{r.randrange(60)}", f"r{r.randrange(60)}", r.choice([0.5, 0.9])) for _ in range(60)]
    df = spark.createDataFrame(pairs, PAIRS)
    assert rows(p1.groups(extra(df))) == union_find(pairs)
    assert p1.groups(df.limit(0)).count() == 0
    assert p1.groups(df.where("left_id = 'x'")).count() == 0


# ---- 2 ----


def share(text):
    w = re.findall(r"[^\W_]+", text.lower())
    seen, covered = set(), set()
    for i in range(len(w) - 5):
        g = tuple(w[i : i + 6])
        if g in seen:
            covered.update(range(i, i + 6))
        seen.add(g)
    return len(covered) / len(w) if len(w) >= 12 else 0.0


def test_repetition_against_brute_force(spark):
    r = random.Random(2)
    texts = [" ".join(r.choice("ab cd ef gh".split()) for _ in range(r.randrange(40))) for _ in range(40)] + ["one two three four five six. " * k for k in range(5)] + ["", "Ünï cödé " * 9, "x" * 50_000, "数学 " * 20]
    payload = [json.dumps({"samples": [{"index": i, "reasoning": t, "solution": None}, {"solution": t}, None], "x": 1}) for i, t in enumerate(texts)]
    data = [(f"r{i}", p, json.dumps({"m": {"solution": t}, "n": None})) for i, (p, t) in enumerate(zip(payload, texts, strict=True))]
    data += [(None, payload[41], None), ("bad", '{"samples": [', "null"), ("empty", "", "{}"), ("list", "[1, 2]", '"x"'), data[42], ("none", None, None)]
    want = {(f"r{i}", f, s, n) for i, t in enumerate(texts) if share(t) >= 0.3 for f, s, n in (("verification", str(i), "reasoning"), ("verification", "1", "solution"), ("distillation", "m", "solution"))}
    df = spark.createDataFrame(data, "record_id string, verification string, distillation string")
    assert rows(p2.found(extra(df))) == want and want
    m = {(r.record_id, r.field): r for r in p2.measured(df).where("text_name = 'solution'").collect()}
    assert all(abs(m[f"r{i}", "distillation"].repeated_share - share(t)) < 1e-9 for i, t in enumerate(texts))
    assert m["r48", "distillation"].script == "han" and m["r46", "distillation"].script == "latin"
    assert p2.found(df.limit(0)).count() == 0


def test_the_entropy_band_loses_nothing():
    r = random.Random(4)
    for _ in range(200):
        t = " ".join(r.choice(["ab", "cd", "ef", "gh", "longerword", "x1"]) for _ in range(r.randrange(12, 60)))
        w = p2.Words([t])
        s = p2.repeated_share(w)[0]
        assert p2.fertility(w, p2.tokens.VOCABULARIES)["repeat_bits"][0] >= 2 * s - 1e-9


# ---- 3 ----


def test_survivors(spark):
    day = lambda n: datetime(2024, 1, n)
    pairs = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0), ("d", "e", 1.0), ("f", "g", 1.0), ("h", "ghost", 1.0)], PAIRS)
    recs = [("a", "t2", "5", day(9)), ("b", "t1", "N/A", day(1)), ("b", "t1", "N/A", day(2)), ("c", "t1", "N/A", day(3)), ("d", None, None, None), ("e", " ", "-", day(1)), ("f", "t1", "1", day(4)), ("g", "t1", "2", day(4)), ("h", "none", "1", day(1)), ("q", "t1", "1", day(1))]
    records = spark.createDataFrame([(i, d, a, t, "q", None) for i, d, a, t in recs], "record_id string, dataset_name string, raw_dataset_answer string, ingested_at timestamp, question string, confirmed_answer string")
    tiers = spark.createDataFrame([("t1", 1), ("t2", 2), (None, 1)], "dataset_name string, tier int")
    assert rows(p3.found(pairs, extra(records).drop("tier"), tiers)) == {("a", "c", "a"), ("d", "e", ""), ("f", "f", "f"), ("ghost", "h", "h")}
    assert p3.found(pairs.limit(0), records, tiers).count() == 0
    assert {(r.group_id, r.value) for r in p3.fields(pairs, records).where("field = 'raw_dataset_answer'").collect()} >= {("d", "-"), ("ghost", "1")}


def test_truth_discovery_trusts_who_agrees(spark):
    claims = [(f"g{i}", "f", "right", s) for i in range(20) for s in ("x", "y", "z")] + [(f"g{i}", "f", f"wrong{i}", "w") for i in range(20)] + [("g1", "f", None, "n")]
    t = p3.discover(spark.createDataFrame(claims, "group_id string, field string, value string, source string"))
    assert t["x"] > 0.9 > 0.2 > t["w"] and "n" not in t


def test_reliabilities_that_do_not_converge_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(p3, "ROUNDS", 1)
    claims = [("g", "f", "x", "a"), ("g", "f", "y", "b"), ("g", "f", "x", "c"), ("h", "f", "y", "a")]
    with pytest.raises(RuntimeError):
        p3.discover(spark.createDataFrame(claims, "group_id string, field string, value string, source string"))


def test_votes_choose_the_highest_support(spark):
    claims = spark.createDataFrame([("g", "f", "x", "a", 0), ("g", "f", "x", "b", 0), ("g", "f", "y", "c", 0), ("h", "f", "z", "a", 2), ("h", "f", "y", "a", 1), ("h", "f", None, "c", 0)], "group_id string, field string, value string, source string, age int")
    got = {(r.group_id, r.value, r.support) for r in p3.chosen(p3.votes(claims, {"a": 0.3, "b": 0.3, "c": 0.5}, "string")).collect()}
    assert got == {("g", "x", 0.6), ("h", "y", 0.3)}


# ---- 4 ----

TRAIN = {
    "en": ["The sum of the two sides is equal to the length of the third one. Now we count the rows and the columns.", "Because the number is odd, only one of them holds. It follows that the answer is less than the limit."],
    "fr": ["La somme des deux côtés est égale à la longueur du troisième. Nous comptons les lignes et les colonnes.", "Parce que le nombre est impair, un seul convient. Il suffit de comparer avec la limite donnée."],
    "de": ["Die Summe der beiden Seiten ist gleich der Länge der dritten. Wir zählen nun die Zeilen und die Spalten.", "Weil die Zahl ungerade ist, gilt nur eine davon. Daraus folgt, dass die Antwort kleiner ist."],
    "zh": ["两边之和等于第三边的长度。现在我们数一数行和列。", "因为这个数是奇数,所以只有一个成立。由此可见答案小于上界。"],
}


@pytest.fixture(scope="module")
def models(spark):
    docs = [(i * 100 + k, lang, " ".join(texts[(i + k) % 2] for k in range(3)) + "\n\n" + texts[i % 2] + f" The value is ${i}$.") for k, (lang, texts) in enumerate(TRAIN.items()) for i in range(40)]
    return p4.train(spark.createDataFrame([*docs, (None, None, "x"), (1, "en", None), (2, "", "y")], "doc_id long, lang string, text string"))


Q = "How many rows and columns does the grid have when the number is odd?"
ANSWERS = [
    (None, "empty_answer"), ("", "empty_answer"), ("​﻿", "empty_answer"), ("\\boxed{}", "empty_answer"), ("$ $", "empty_answer"), ("N/A", "empty_answer"), ("[no answer]", "empty_answer"), ("Answer:", "empty_answer"), ("—", "empty_answer"), ("<br>", "empty_answer"),
    ("12", None), ("x = 3", None), ("[4, 184]", None), ("(1, 2]", None), ("-188x*47y + 165", None), ("\\frac{1}{2}", None), ("8\\pi", None), ("383 discs", None), ("0", None), ("No", None),
    ("x = 6 +", "truncated_answer"), ("$\\sqrt{6", "truncated_answer"), ("(70, ", "truncated_answer"), ("\\frac{1}{", "truncated_answer"), ("The sum of the two sides is equal to the len", "truncated_answer"), ("The sum of the two sides is $4$. $\\boxed{4}$", None), ("The sum of the two sides is 4.<br>", None),
    ("I cannot solve this request.", "refusal"), ("Sorry, I'd rather not answer this one!", "refusal"), ("抱歉,我无法回答这个问题。", "refusal"), ("Il m'est impossible d'aider ici.", "refusal"), ("It cannot be determined from the first line alone, but the second one settles it. The sum is 4.", None),
    (Q, "question_copy"), (Q.upper(), "question_copy"), (f"Question: {Q}", "question_copy"), (f"“{Q}”", "question_copy"), (f"{Q}\n{Q}", "question_copy"), (f"{Q} The sum of the sides is 4.", None), (f"Q. {Q}", "question_copy"),
    ("La somme des deux côtés est égale à la longueur du troisième.", "other_language"), ("两边之和等于第三边的长度。现在我们数一数行和列。", "other_language"), ("Following the text «La somme des deux côtés est égale à la longueur.» we count the rows and the columns. The sum is 4.", None),
]


@pytest.mark.parametrize(("answer", "want"), ANSWERS)
def test_defects(models, answer, want):
    assert p4.defect(Q, answer, *models, p6.model()) == want


@pytest.mark.parametrize(("answer", "want"), [
    ("I'm sorry, I cannot help with problem 3, 4 and 5 here.", "refusal"), ("The text asks about a grid and its rows, with many columns, as was described by the author of the book at very great length indeed: I cannot answer.", "refusal"), ("Ich bin nicht in der Lage, das zu beantworten.", "refusal"), ("We cannot take 3 from 2, so 5 of the 6 and then 7 remain.", None),
    ("The sum of the two sides is equal to th...", "truncated_answer"), ("The sum of the two sides is eq…", "truncated_answer"), ("1, 2, 3, ...", None), ("He has it", "truncated_answer"), ("\\begin{align}\\end{align}\\begin{gather}\\end{gather}\\begin{cases}\\end{cases}", "empty_answer"),
    (f"This is the text of the question that was put to me some time ago: {Q}", "question_copy"), (f"Since x = 4 we have: {Q}", None),
])
def test_no_length_decides(models, answer, want):
    assert p4.defect(Q, answer, *models, p6.model()) == want


def test_a_rare_language_is_kept_and_a_wrong_label_is_none(spark):
    docs = [(i, "en", " ".join(TRAIN["en"]) + f" Part {i}.") for i in range(400)] + [(1000, "fr", " ".join(TRAIN["fr"])), (1001, "xx", "Now we count the rows and the columns. It follows that only one of them holds.")]
    languages, _ = p4.train(spark.createDataFrame(docs, "doc_id long, lang string, text string"))
    assert languages.names == ["en", "fr"]


def test_every_document_and_place_counts(spark):
    n, text = 20_500, "Every one of the texts counts, not some of them."
    languages, ends = p4.train(spark.range(n).selectExpr("id as doc_id", "'en' as lang", f"'{text}' as text"))
    one = np.bincount(p4._trigrams(text), minlength=p4.BUCKETS)
    assert languages.log[:, 0] == pytest.approx(np.log((one * n + 0.5) / ((one * n).sum() + 0.5 * p4.BUCKETS)), abs=1e-4)
    assert ends.counts["."] == (n, 0) and ends.total == pytest.approx((n + 1, n + 1))
    assert sum(b for s, (_, b) in ends.counts.items() if len(s) == 2) == pytest.approx(n)


def test_ends_are_counted_at_all_places_inside():
    texts = [f"{a}{b} 12 ≤ xⅣ 字字\n(Ω).{c}" for a in ("", "      ", "A\t\t  \n") for b in ("one two", "\ue000\ud800́", "e" * 90) for c in ("", "!", "∎")]
    want = {}
    for t in texts:
        for k in range(5, len(t) - 1):
            s = p4.ending(t[:k])
            for m in range(1, len(s) + 1):
                want.setdefault(s[-m:], [0, 0])[1] += p4._ONE // (len(t) - 6)
        s = p4.ending(t)
        for m in range(1, len(s) + 1):
            want.setdefault(s[-m:], [0, 0])[0] += p4._ONE
    assert p4.end_counts(texts) == {s: tuple(x) for s, x in want.items()} and p4.end_counts([]) == {}


def test_defects_over_a_table(spark, models):
    docs = spark.createDataFrame([(1, None, None)], "doc_id long, lang string, text string")
    df = spark.createDataFrame([("a", Q, None), ("a", Q, None), ("b", None, "12"), ("c", None, None), (None, Q, ""), ("d", Q, "word " * 30_000 + "end."), ("e", "", "La somme.")], "record_id string, question string, raw_dataset_answer string")
    assert rows(p4.found(extra(df), docs)) == {("a", "empty_answer"), ("c", "empty_answer")}
    assert p4.found(df.limit(0), docs.limit(0)).count() == 0


# ---- 5 ----


def words(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))


@pytest.mark.parametrize("hot", [p5.HOT, 2])
def test_repeats_against_brute_force(spark, hot):
    r = random.Random(8)
    base = [words(r, 12) for _ in range(40)]
    cluster = [base[0][:i] + "zz" + base[0][i + 2 :] for i in range(0, 60, 3)]  # near copies of one question
    edit = lambda t, n: "".join(r.choice("qrstuv") if r.random() < n else c for c in t)
    canonical = base + cluster + [base[1].upper() + "!!", "", None, "ab"]
    incoming = []
    for b in range(1, 5):
        incoming += [(f"u{b}-{i}", edit(r.choice(base), r.choice([0, 0.01, 0.03, 0.08, 0.3])), b) for i in range(25)] + [(f"v{b}", words(r, 12), b), (f"s{b}", "Ab", b), (f"e{b}", "", b), (f"n{b}", None, b), (None, base[2], b)]
    incoming += [("twin1", "all new words stand here together", 2), ("twin2", "all new words stand here together", 2), ("late", "All new words: stand here together", 3), ("nobatch", base[3], None), incoming[0]]
    norm = lambda t: " ".join(re.sub(r"\W", " ", (t or "").lower()).split())
    known = [(norm(t), 0) for t in canonical] + [(norm(t), b) for _, t, b in incoming if b is not None]
    want = {u for u, t, b in incoming if u and any(n < (b if b is not None else 1) and p5.similar(norm(t), x) for x, n in known)}
    got = {r.uid for r in p5.repeats(spark.createDataFrame([(t,) for t in canonical], "question string"), extra(spark.createDataFrame(incoming, "uid string, question string, batch_no int")), hot=hot).where("uid is not null").collect()}
    assert got <= want and len(got) >= 0.97 * len(want) and {"late", "s1", "nobatch"} <= got and "twin1" not in got


def test_a_match_in_an_earlier_batch_is_found_where_all_slots_are_hot_in_the_base(spark):
    r = random.Random(5)
    first = words(r, 12)
    second = first[:-1] + ("q" if first[-1] != "q" else "r")
    base = set()
    while len(base) < 1_500:
        t = list(first)
        for i in r.sample(range(len(t)), 5):
            t[i] = r.choice("qrstuv")
        if not any(p5.similar("".join(t), x) for x in (first, second)):
            base.add("".join(t))
    wide = lambda texts: [(t, int(k) >> 8 * (p5.DEPTH - p5.WIDEST)) for row in p5.keys_of(texts)[0] for t, k in enumerate(row)]
    known = Counter(wide(sorted(base)))
    assert p5.similar(first, second) and all(known[k] > 2 for k in wide([first, second]))
    incoming = spark.createDataFrame([("a", first, 1), ("b", second, 2), ("c", words(r, 12), 2)], "uid string, question string, batch_no int")
    canonical = spark.createDataFrame([(t,) for t in base], "question string")
    assert {x.uid for x in p5.repeats(canonical, incoming, hot=2).collect()} == {"b"}


def test_repeats_of_empty_tables(spark):
    c, i = spark.createDataFrame([], "question string"), spark.createDataFrame([("u", "some words here", 1)], "uid string, question string, batch_no int")
    assert p5.found(c, i).count() == 0 and p5.found(c, i.limit(0)).count() == 0


def test_a_cluster_born_in_the_first_batch(spark):
    r = random.Random(11)
    seed = words(r, 12)
    near = sorted({seed[:i] + c + seed[i + 1 :] for i in range(0, 60, 2) for c in "qr"})
    incoming = [(f"a{i}", t, 1) for i, t in enumerate(near[:40])] + [(f"b{i}", t, 2) for i, t in enumerate(near[40:])] + [("c", words(r, 12), 2)]
    got = {x.uid for x in p5.repeats(spark.createDataFrame([(words(r, 12),)], "question string"), spark.createDataFrame(incoming, "uid string, question string, batch_no int"), hot=2).collect()}
    assert got == {u for u, _, _ in incoming if u.startswith("b")}


def test_a_later_session_opens_the_forest_and_reads_only_what_a_batch_needs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(p5, "RUNS", 2)
    r = random.Random(12)
    base = [words(r, 10) for _ in range(400)]
    path = f"file://{tmp_path}/forest"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "96")
    try:
        p5.HashForest(spark, path).build(spark.createDataFrame([(t,) for t in base], "question string"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    run = p5.HashForest.open(spark, path).runs[0]
    assert run.keys.select(F.input_file_name(), "block").distinct().count() == run.keys.select("block").distinct().count() > 48  # a block is a file
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "forest" / run.name).rglob("*.parquet")}
    batch = lambda *texts: spark.createDataFrame([(t,) for t in texts], "text string").select(F.xxhash64("text").alias("tid"), "text", F.lit(1).cast("long").alias("since"))
    again = p5.HashForest.open(spark, path)
    assert {x.text for x in again.accept(batch(base[7][:-1] + "z", "quite another text of several words")).collect()} == {base[7][:-1] + "z"}
    assert all(n <= 48 + 2 < of for n, of in again.blocks_read if of == run.blocks) and again.blocks_read
    assert files == {f: f.stat().st_mtime_ns for f in (tmp_path / "forest" / run.name).rglob("*.parquet")}
    last = p5.HashForest.open(spark, path)
    assert {x.text for x in last.accept(batch("quite another text of several wordz")).collect()} == {"quite another text of several wordz"}
    for k in range(p5.RUNS):
        last.accept(batch(f"text of the batch with number {k} which is new " + words(r, 6)))
    assert len(last.runs) <= p5.RUNS + 1 and {x.text for x in last.accept(batch(base[3], "quite another text of several word")).collect()} == {base[3], "quite another text of several word"}
    last.drop()


def test_the_measured_recall_widens_prefixes(spark):
    r = random.Random(13)
    base = [words(r, 12) for _ in range(60)]
    edit = lambda t: "".join(r.choice("qrstuv") if r.random() < 0.025 else c for c in t)
    f = p5.HashForest(spark, recall=0.999999).build(spark.createDataFrame([(t,) for t in base], "question string"))
    batch = spark.createDataFrame([(edit(t),) for t in base], "text string").select(F.xxhash64("text").alias("tid"), "text", F.lit(1).cast("long").alias("since"))
    f.accept(batch)
    assert [d for d, _ in f.met_at] == [8, 7, 6] and [x for _, x in f.met_at] == sorted(x for _, x in f.met_at)
    f.drop()
    assert p5.chance(0.8, p5.WIDEST) > 0.999 and p5.chance(0.8, p5.DEPTH) < 0.99


@pytest.mark.parametrize("text", ["I cannot answer.", "The question asks for " + "the area of a large field " * 12 + "by the river. I cannot answer this question.", "I cannot answer this question. " + "It is not clear what is meant by it. " * 40])
def test_refusals_of_any_length(text, models):
    assert p4.is_refusal(text) and p4.defect(Q, text, *models, p6.model()) == "refusal"


# ---- 6 ----


@pytest.mark.parametrize("switch", ["bf", "it", "em", "tt", "sc", "rm", "large", "Large", "small"])
def test_a_style_switch_alone_is_parsed(switch):
    assert p6.kinds(f"some {{\\{switch} marked}} words here", p6.model()) == {"latex"}


MARKUP = [
    ("Find <b>x</b> now.", {"html"}), ("One<br/>two.<BR>", {"html"}), ("a &nbsp;b", {"html"}), ("<!-- row --> text", {"html"}), ("Assume 2 < n and u > 50.", set()), ("Use a*b*c = 294 for R&D lot #59.", set()),
    ("## Series\n\nText here.", {"markdown"}), ("- first item\n- second item", {"markdown"}), ("some **bold** word", {"markdown"}), ("![plot](img/a.png)\nText", {"markdown"}), ("see [the page](https://a.example/b)", {"markdown"}), ("text\n\n```python\nprint(1)\n```", {"markdown"}), ("> quoted words here\n> and more words", {"markdown"}), ("| given | value |\n|---|---|\n| x | 4 |\n\nText", {"markdown"}), ("this ~~the~~ word", {"markdown"}),
    ("== Vectors ==\nText", {"wiki"}), ("the [[Lial|word]] here", {"wiki"}), ("it ''is'' so", {"wiki"}), ("{{name|level=1}} Text", {"wiki"}), ('{| class="grid"\n|-\n| 1 || 2\n|}\nText', {"wiki"}), ("The matrix is [[8,2],[1,8]].", set()), ("Here S = {{6,2},{3}} and p_1 = p_2.", set()), ("Note 5 - 3 - 0 and f''(x) = 6, g'(x) == 0.", set()),
    ("\\section*{Limits}\nText", {"latex"}), ("a \\textbf{word} here", {"latex"}), ("\\begin{itemize}\n\\item one\n\\end{itemize}", {"latex"}), ("text\n\\vspace{3mm}", {"latex"}), ("text \\footnote{note here} more", {"latex"}), ("\\noindent Text", {"latex"}), ("$\\frac{1}{2} < x$ and \\sqrt{4}", set()), ("$\\begin{pmatrix} 1 & 2 \\end{pmatrix}$", set()), ("[4, 184]", set()), ("{1,2,3}", set()), ("-188x*47y + 165", set()), ("\\boxed{4}", set()),
    ("## Head\n\nText\n\\vspace{2mm}", {"markdown", "latex"}), ("", set()), (None, set()), ("x" * 100_000, set()),
]


@pytest.mark.parametrize(("field", "want"), MARKUP)
def test_markup_kinds(field, want):
    assert p6.kinds(field, p6.model()) == want


@pytest.mark.parametrize(("field", "want"), [("<h2>Head</h2><p>Text &amp; more</p>", "## Head\n\nText & more"), ("<ul><li>one</li>\n<li>two</li></ul>", "- one\n\n- two"), ("== Head ==\nThe [[Page|word]] ''is'' here.", "## Head\n\nThe word is here."), ("\\section*{Head}\nA \\textbf{bold} $x^2$ word.", "# Head\n\nA bold $x^2$ word."), ("plain text", "plain text"), (None, None)])
def test_clean(field, want):
    assert p6.clean(field, p6.model()) == want


def test_message_passing_against_enumeration():
    from itertools import product

    m = p6.model()
    nodes = p6.parse("<b>x</b> and [[8,2]] ''y'' &amp;")
    weight = {}
    for s in product((0, 1), repeat=len(nodes)):
        p = 1.0
        for i, n in enumerate(nodes):
            p *= m.edge[n.name][s[n.parent] if i else 0][s[i]]
            for f, v in n.features:
                p *= m.unary.get((n.name, f, v), m.unseen.get((n.name, f), m.flat))[s[i]]
        weight[s] = p
    total = sum(weight.values())
    want = [sum(p for s, p in weight.items() if s[i]) / total for i in range(len(nodes))]
    assert np.allclose(m.marginals(nodes), want)


@pytest.mark.parametrize(("field", "want"), [("<p>The sum is 4.</p><script>var x = 1; f(x);</script>", "The sum is 4."), ("<style>.a { margin: 3px; color: red; }</style>Find x.", "Find x."), ('<nav><a href="/a">home</a> <a href="/b">all pages</a></nav><p>Find the sum.</p>', "Find the sum."), ("<div>Find <b>the</b> sum.</div>", "Find the sum.")])
def test_boilerplate_goes(field, want):
    assert p6.clean(field, p6.model()) == want


def test_held_out_pages():
    got = p6.held_out(p6.model(), 500)
    assert min(got["markup"]) > 0.97 and min(got["content"]) > 0.97


def test_long_lists_take_linear_time():
    import time

    took = []
    for n in (2_000, 8_000):
        began = time.time()
        p6.parse("- item of the list\n" * n)
        took.append(time.time() - began)
    assert took[1] < 12 * max(took[0], 0.01)


def test_markup_over_a_table(spark):
    df = spark.createDataFrame([("a", "x<br>", None), ("a", "x<br>", None), (None, "y<br>", ""), ("b", None, "**w** <p>t</p>")], "record_id string, question string, raw_dataset_answer string")
    assert rows(p6.found(extra(df))) == {("a", "question", "html"), ("b", "raw_dataset_answer", "html"), ("b", "raw_dataset_answer", "markdown")}
    assert p6.cleaned(df).count() == 4 and p6.found(df.limit(0)).count() == 0


# ---- 7 ----


def test_leaks_against_brute_force(spark):
    r = random.Random(6)
    vocabulary = [words(r, 1) for _ in range(30)]
    items = [(f"i{k}", " ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 30)))) for k in range(25)] + [("i0", "another text of the first item"), ("w", "?!"), (None, "a b c"), ("n", None)]
    docs = []
    for k in range(60):
        q = r.choice(items[:26])[1].split()
        a = r.randrange(len(q))
        docs.append((k, " ".join([*(r.choice(vocabulary) for _ in range(20)), *(x.upper() + r.choice([",", " -"]) for x in q[a : a + r.randrange(1, 30)]), *(r.choice(vocabulary) for _ in range(20))])))
    docs += [(60, None), (61, ""), (None, items[1][1]), docs[0], (62, items[3][1]), (63, "pad " * 30_000 + items[4][1])]
    tokens = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = set()
    for d, t in docs:
        for u, q in items:
            w, x = tokens(t), tokens(q)
            n = -(-len(x) // 2)
            runs = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            if d is not None and u is not None and n and any(tuple(x[j : j + n]) in runs for j in range(len(x) - n + 1)):
                want.add((d, u))
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "uid string, question string")
    assert rows(p7.found(extra(d), extra(i))) == want and len(want) > 20
    assert p7.found(d.limit(0), i).count() == 0 and p7.found(d, i.limit(0)).count() == 0


def test_items_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(p7, "ITEMS", 2)
    i = spark.createDataFrame([(f"i{k}", f"alpha beta gamma word{k} delta") for k in range(5)], "uid string, question string")
    d = spark.createDataFrame([(k, f"so alpha beta gamma word{k} delta it is") for k in range(5)], "doc_id long, text string")
    assert {(k, f"i{k}") for k in range(5)} <= rows(p7.found(d, i))


# ---- 8 ----


def test_mixing(spark):
    docs = [(i, "word " * 100, "big") for i in range(400)] + [(1000 + i, "word " * 100, "small") for i in range(10)] + [(2000, "x", None), (2001, None, "big"), (2002, "y", "unlisted"), (0, "word " * 100, "big"), (None, "z", "big")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    t = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 3), ("none", 0.2, 2), (None, 0.1, 1), ("big", 0.4, None)], "source string, target_share double, max_repeats int")
    assert rows(p8.found(extra(d), t)) == {("small",), ("none",)}
    plan = {r.doc_id: r.times for r in p8.plan(d, t).collect()}
    assert all(plan[1000 + i] == 3 for i in range(10)) and max(plan[i] for i in range(400)) <= 1
    m = {r.source: r for r in p8.report(d, t).collect()}
    assert m["none"].used_tokens == 0 and m["small"].most_repeats == 3 and abs(sum(r.actual_share for r in m.values()) - 1) < 1e-9
    assert rows(p8.found(d.limit(0), t)) == {("big",), ("small",), ("none",)} or p8.found(d.limit(0), t).count() in (0, 3)
    assert p8.found(d, t.limit(0)).count() == 0
    assert {(r.short, r.within_budget, r.within_repeats) for r in p8.budgets(d, t).collect()} == {(False, True, True), (True, True, True)}


def test_budget_ends_inside_a_block(spark, monkeypatch):
    monkeypatch.setattr(p8, "BLOCK", 7)
    d = spark.createDataFrame([(i, "word " * (1 + i % 9), "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    t = spark.createDataFrame([("a", 0.6, 5), ("b", 0.3, 5), ("c", 0.1, 5)], "source string, target_share double, max_repeats int")
    m = {r.source: r for r in p8.report(d, t).collect()}
    assert all(abs(m[s].actual_share - x) < 0.01 for s, x in (("a", 0.6), ("b", 0.3), ("c", 0.1)))


def test_how_far_sources_can_follow():
    far = p8.reach([900, 100, 0, 500], [0.3, 0.4, 0.1, 0.2], [1, 2, 5, 1])
    assert far[0] == far[3] == 1.0 and 0 < far[1] < 1 and far[2] == 0.0
    p, t = [0.6, 1 / 15, 0.0, 1 / 3], [0.3, 0.4, 0.1, 0.2]
    w = [a ** (1 - far[1]) * b ** far[1] if a else 0.0 for a, b in zip(p, t, strict=True)]
    assert abs(w[1] / sum(w) - 2 / 15) < 1e-6
    assert p8.reach([10], [1.0], [1]) == [1.0] and p8.reach([], [], []) == []


def test_temperature_meets_the_entropy():
    e, w = p8.temper([0.7, 0.2, 0.1, 0.0], 1.4)
    assert abs(-sum(x * np.log2(x) for x in w if x) - 1.4) < 1e-6 and e < 1 and w[3] == 0


# ---- 9 ----


def brute_spans(docs, n):
    out = set()
    for i, (a, s) in enumerate(docs):
        grams = {s[k : k + n] for k in range(len(s or "") - n + 1)} if s else set()
        for b, t in docs[i + 1 :]:
            if t and a is not None and b is not None and a != b and any(t[k : k + n] in grams for k in range(len(t) - n + 1)):
                out.add((min(a, b), max(a, b)))
    return out


@pytest.mark.parametrize("group", [p9.GROUP, 1])
def test_shared_spans_against_brute_force(spark, group):
    r = random.Random(9)
    make = lambda n: "".join(r.choice("abcdefgh \n") for _ in range(n))
    spans = [make(n) for n in (28, 29, 30, 31, 32, 45, 90)]
    docs = [(k, make(r.randrange(60)) + r.choice(spans)[r.randrange(3) :] + make(r.randrange(60))) for k in range(60)]
    docs += [(100, "=" * 80), (101, "x" + "=" * 40 + "y"), (102, "x" + "=" * 25 + make(9)), (103, None), (104, ""), (105, "short"), docs[0], (None, docs[0][1]), (106, docs[1][1]), (107, docs[1][1]), (108, "𝔘" * 40), (109, "𝔘" * 35 + "z")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(p9.found(extra(df), 30, group)) == brute_spans(docs, 30)
    assert p9.found(df.limit(0), 30).count() == 0


def test_prefixes_are_lengthened_until_groups_fit(spark):
    r = random.Random(14)
    make = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    footer, inner = make(26), make(18)
    docs = [(k, make(r.randrange(40)) + footer[r.randrange(4) :] + make(r.randrange(20))) for k in range(40)] + [(50 + k, make(20) + inner + "zy"[k % 2] * (k % 16) + make(9)) for k in range(40)]
    docs += [(100 + k, make(11) + footer + make(12)) for k in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for group in (4, 15):
        assert rows(p9.found(df, 24, group)) == brute_spans(docs, 24)
    m = p9.members(df, 24).collect()
    assert {tuple(sorted((x.doc_id, y.doc_id))) for x in m for y in m if x.passage == y.passage and x.doc_id != y.doc_id} == brute_spans(docs, 24)


def test_many_copies_become_a_star_but_no_link_is_lost(spark):
    r = random.Random(1)
    a, b = ("".join(r.choice("abcdef") for _ in range(50)) for _ in range(2))
    docs = [(k, a + b) for k in range(6)] + [(10, "start" + b)]
    got = rows(p9.found(spark.createDataFrame(docs, "doc_id long, text string"), 30, copies_max=4))
    assert got == {(0, k) for k in range(1, 6)} | {(0, 10)}


def test_coverage(spark):
    r = random.Random(3)
    a, b, c = ("".join(r.choice("abcdefgh") for _ in range(n)) for n in (100, 60, 70))
    got = {x.doc_id: (x.shared_chars, x.n_chars) for x in p9.shared(spark.createDataFrame([(1, a + b), (2, a + c), (3, c), (4, "none"), (5, None)], "doc_id long, text string"), 30).collect()}
    assert got == {1: (100, 160), 2: (170, 170), 3: (70, 70), 4: (0, 4), 5: (0, 0)}


def test_every_problem_has_its_query():
    assert {f"p{n}_found" for n in range(1, 10)} <= set(catalog.QUERIES)
