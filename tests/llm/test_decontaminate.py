from pyspark.sql import functions as F

from cardwatch.llm import decontaminate as dc
from cardwatch.llm import queries

SF0001 = "/root/testdata/sf0.001"
ITEM = "A train leaves Boston at 9 with 40 kg of coal while Maria drives 120 km home and later Maria counts 40 boxes in the yard."
ITEMS = [(1, ITEM), (2, ITEM), (3, "short item here"), (4, None), (5, ""), (6, "one two three four five six seven eight nine ten eleven twelve thirteen"),
         (None, "zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau")]


def _found(spark, rows, items=ITEMS):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(1)).withColumn("size", F.lit(1))
    return [(r["doc_id"], r["item_ids"], r["contaminated"]) for r in dc.contaminated(docs.withColumn("slots", F.lit(1)), bench).collect()]


def test_parameters_may_change_but_consistently(spark):
    other = ITEM.replace("Boston", "Lyon").replace("Maria", "Ahmed").replace("40", "55").replace("120", "7").replace(" 9 ", " 11 ").replace("kg", "lbs")
    mixed = ITEM.replace("Maria counts", "Peter counts").replace("40 boxes", "41 boxes")
    swapped = ITEM.replace("Boston", "Maria")
    filler = "Some words of the document come before it. "
    rows = [(1, filler + ITEM + " And after."), (2, filler + other), (3, filler + mixed), (4, swapped), (5, ITEM.lower()), (6, filler * 3),
            (7, "X\n" + ITEM[:60]), (8, ITEM.replace(" at ", " , at ! ").replace("home", "HOME"))]
    got = {d: ids for d, ids, _ in _found(spark, rows)}
    assert got[1] == got[2] == [1, 2]
    # a long verbatim stretch counts by itself, whatever was changed beside it
    assert got[3] == [1, 2] and got[4] == [1, 2] and got[6] == []
    assert got[8] == [1, 2]


def test_other_values_must_be_consistent(spark):
    """Every second word or so is a value, so no eight words in a row are the item's own."""
    item = "if Anna has 12 red pens and Berta has 7 blue pens then Anna gives 12 to Berta and Berta gives 7 to Anna again today"
    to = lambda **v: " ".join(v.get("_" + w, w) for w in item.split())
    same = to(_Anna="Carla", _Berta="Dora", _12="31", _7="8")
    two_for_one = same.replace("gives 31", "gives 33")
    one_for_two = to(_Anna="Carla", _Berta="Carla", _12="31", _7="8")
    rows = [(1, same), (2, two_for_one), (3, one_for_two), (4, item.replace("12", "13", 1))]
    got = {d: ids for d, ids, _ in _found(spark, [(d, "Well, " + t + " and so on") for d, t in rows], [(1, item)])}
    assert got == {1: [1], 2: [], 3: [], 4: [1]}


def test_a_copy_with_one_edited_figure(spark):
    item = ("The school bought 12 boxes of chalk and 30 boxes of paper for the new rooms on the second floor because the old stock "
            "had run out, and each of the 12 boxes of chalk was shared by two rooms.")
    rows = [(1, "See: " + item), (2, "See: " + item.replace("the 12 boxes", "the 13 boxes")), (3, "See: " + item.replace("30", "12"))]
    assert {d: ids for d, ids, _ in _found(spark, rows, [(7, item)])} == {1: [7], 2: [7], 3: [7]}


# ---------------------------------------------------------------- brute force, on words that are easy to tell
def _kinds(text):
    """(canonical word, own word, is a slot) of a text in which sentences end with a full stop."""
    out, begins, number = [], True, False
    for line in text.split("\n"):
        begins = True
        for token in line.split():
            core = token.strip(".,!?;:")
            if core:
                low = core.lower()
                kind = ("number" if any(c.isdigit() for c in core) else "unit" if number and low in dc.UNITS
                        else "name" if not begins and core != low and core[1:] == low[1:] and len(core) > 1 else None)
                out.append((f"<{kind}>" if kind else low, low, kind))
                number = kind == "number"
            begins = token[len(token.rstrip(".,!?;:")):].strip(",") != "" if core else begins
    return out


def _brute(doc, item):
    """Whether the item is in the document, by comparing every window with every window."""
    d, w = _kinds(doc), _kinds(item)
    size = min(dc.WINDOW, len(w))
    if not size:
        return False
    n = len(w) - size + 1
    template_at = [i for i in range(n) if sum(k is None for _, _, k in w[i:i + size]) >= min(dc.MIN_LITERALS, size)]
    for shift in range(-len(w), len(d)):
        own, as_template, pairs = set(), set(), set()
        for i in range(n):
            j = i + shift
            if j < 0 or j + size > len(d):
                continue
            a, b = w[i:i + size], d[j:j + size]
            if [x[1] for x in a] == [x[1] for x in b]:
                # the same words meet as such if both have slots or neither has
                if all(x[2] is None for x in a) == all(x[2] is None for x in b):
                    own.add(i)
            if i in template_at and [x[0] for x in a] == [x[0] for x in b]:
                as_template.add(i)
                pairs |= {((x[2], x[1]), (y[2], y[1])) for x, y in zip(a, b) if x[2]}
                if all(x[1] == y[1] for x, y in zip(a, b)):
                    own.add(i)
        consistent = len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
        if len(own) >= min(dc.MIN_WINDOWS, n):
            return True
        if consistent and (len(own | as_template) >= min(dc.MIN_WINDOWS, n)
                           or (template_at and len(as_template) >= min(dc.MIN_WINDOWS, len(template_at)))):
            return True
    return False


def test_random_edits_against_brute_force(spark):
    import random

    rng = random.Random(12)
    plain = "the of red blue tall house near water walks takes gives under green old new then box".split()
    names, numbers = "Anna Berta Carla Dora Emil".split(), "3 4 12 57 800".split()

    def word():
        x = rng.random()
        return rng.choice(names) if x < .15 else rng.choice(numbers) + rng.choice(["", " kg", " days"]) if x < .3 else rng.choice(plain)

    def sentence(n):
        return "so " + " ".join(word() for _ in range(n)) + rng.choice([".", ".", "!"])

    items = [(i, " ".join(sentence(rng.choice([1, 4, 9, 15])) for _ in range(rng.choice([1, 1, 2])))) for i in range(25)]
    rows = []
    for i, item in items * 4:
        words = item.split()
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            at = rng.randrange(len(words))
            words[at] = rng.choice([word().split()[0], words[at].upper(), words[at] + ",", rng.choice(numbers)])
        text = " ".join(words)
        if rng.random() < .4:  # the same change throughout
            a, b = rng.choice(names + numbers), rng.choice(["Gerda", "99", "Emil", "57"])
            text = " ".join(b if t == a else t for t in text.split())
        if rng.random() < .3:
            text = " ".join(text.split()[rng.randrange(4):])
        rows.append((len(rows), sentence(rng.randrange(6)) + "\n" + text + " " + sentence(rng.randrange(6))))
    got = {d: set(ids) for d, ids, _ in _found(spark, rows, items)}
    want = {d: {i for i, item in items if _brute(text, item)} for d, text in rows}
    assert got == want
    assert 20 < sum(map(len, want.values())) and any(not x for x in want.values())


def test_the_bitmap_grows_with_the_windows():
    assert [dc.bitmap_bits(n) for n in (0, 1, 1 << 17, (1 << 17) + 1, 1 << 20, 1 << 22, 1 << 40)] == [23, 23, 23, 24, 26, 28, 28]


def test_items_that_are_mostly_slots_match_the_same_values(spark):
    sums = "What is 12 + 35 - 7 when 9 + 16 and 81 - 4 and 25 + 36 are 49 and 64 or 100 and 121"
    names = "Then Anna Berta Clara Dora Emma Frida Gerda Hanna Ida Johanna Karla Lina Marta met"
    items = [(1, sums), (2, names), (3, "Is Paris nice"), (3, "Is Paris nice")]
    filler = "Some words of the document come before it. "
    rows = [(1, filler + sums + " and more"), (2, filler + sums.replace("16", "17").replace("36", "37").replace("7 when", "8 when")),
            (3, filler + names), (4, filler + names.replace("Emma", "Erna").replace("Ida", "Ilse")), (5, "is it so? Is Paris nice, or not"),
            (6, filler + "Is London nice"), (7, None)]
    got = {d: ids for d, ids, _ in _found(spark, rows, items)}
    assert got == {1: [1], 2: [], 3: [2], 4: [], 5: [3], 6: [], 7: []}


def test_copies_in_other_case_and_without_punctuation(spark):
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet").select("item_id", "text").collect()
    forms = (str.lower, str.upper, lambda t: "".join(x for x in t if x.isalnum() or x.isspace()),
             lambda t: " ".join(w.capitalize() for w in t.split()))
    rows = [(1000 * k + r["item_id"], "Words before. " + form(r["text"]) + " Words after.") for k, form in enumerate(forms) for r in items]
    for d, ids, _ in _found(spark, rows, [tuple(r) for r in items]):
        assert d % 1000 in ids, rows[d]


def test_edges(spark):
    w = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(1, "x short item here y"), (2, "short item"), (3, w), (3, w), (4, "pad " + w.upper() + " pad"), (5, " ".join(w.split()[:12]) + " other"),
            (None, w), (6, None), (7, ""), (8, "p " * 40000 + w), (9, ITEMS[-1][1]), (10, w), (10, "a clean text of the same id")]
    got = sorted(_found(spark, rows), key=str)
    # twelve words are five of the six windows of the item: not enough
    want = [(1, [3], True), (2, [], False), (3, [6], True), (3, [6], True), (4, [6], True), (5, [], False), (None, [6], True), (6, [], False),
            (7, [], False), (8, [6], True), (9, [], False), (10, [6], True), (10, [], False)]
    assert [g for g in got if g[0] != 9] == sorted((x for x in want if x[0] != 9), key=str)
    assert all(r[2] is False or r[1] is not None for r in got)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_key", F.lit("clash"))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = dc.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        ((d, t) for d, t in rows if (d, t) in [(2, rows[1][1]), (5, rows[5][1]), (6, None), (7, ""), (10, rows[-1][1])]), key=str)
    assert dc.contaminated(docs.where("false"), bench).collect() == []
    none = dc.contaminated(docs, bench.where("false")).collect()
    assert len(none) == len(rows) and not any(r["contaminated"] for r in none)


def test_query_against_a_search_for_whole_items(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()
    flat = {r["item_id"]: " ".join(r["text"].split()) for r in items}
    got = {r["doc_id"]: r["item_ids"] for r in queries.op9_decontaminate(spark, SF0001).collect()}
    for r in docs:
        text = " ".join(r["text"].split())
        assert got[r["doc_id"]] == ",".join(str(i) for i in sorted(flat) if flat[i] in text), r["doc_id"]


def test_a_task_works_on_little_text_at_once():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    texts = [f"Row {i} says: " + ("some plain words stand in this text, 12 of them or so. " * 40 if i % 50 else ITEM) for i in range(2000)]
    rows = pa.RecordBatch.from_arrays([pa.array(map(str, range(2000))), pa.array(range(2000), pa.int64()), pa.array(texts)], names=["_key", "_th", "text"])
    assert rows.column("text").nbytes > 4_000_000
    bits = np.zeros(1 << 17, np.uint64)
    h, _, _ = dc.windows(dc.Canonical(pa.array([ITEM])), dc.WINDOW)
    bits[h.view(np.uint64) >> np.uint64(47)] = np.uint64(0xFFFFFFFFFFFFFFFF)
    tracemalloc.start()
    found = [r for b in dc._passing(iter([rows]), bits, 23, [dc.WINDOW]) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64e6
    alone = [r for i in range(2000) for b in dc._passing(iter([rows.slice(i, 1)]), bits, 23, [dc.WINDOW]) for r in b.to_pylist()]
    assert sorted(map(str, found)) == sorted(map(str, alone)) and {r["_key"] for r in found} >= {str(i) for i in range(0, 2000, 50)}
