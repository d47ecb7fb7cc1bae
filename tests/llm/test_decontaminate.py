import re

from barlab.llm import decontaminate
from barlab.llm.queries import op8_decontaminate, table
from conftest import SF001
from llm_rows import CLASHES, docs, empty

ITEMS = [
    (1, "A train leaves Boston at 30 miles per hour and reaches Denver after 7 hours, how far is it between Boston and Denver"),
    (2, "the quick tests are few"),
    (3, "12 14 16 18 20 22 24 26 28 30"),
    (4, None),
    (5, ""),
    (6, "two words"),
]


def bench(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


def leaks(spark, texts):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    return {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs(spark, rows), bench(spark)).collect()}


def test_exact_and_reparameterised_questions(spark):
    exact = ITEMS[0][1]
    moved = "Some text first. More of it here\n" + exact.replace("Boston", "Lisbon").replace("30", "45").replace("Denver", "Madrid").replace("7", "9") + " and then it goes on for a while"
    mixed = exact.replace("reaches Denver", "reaches Paris")  # the same slot, two values
    both = exact.replace("Boston", "Denver")  # two slots, one value
    got = leaks(spark, [exact, moved, mixed, both, "nothing of the kind is in this one at all", None, "", "12 14 16 18 20 22 24 26 28 30"])
    assert set(got) == {(0, 1), (1, 1)}
    assert got[0, 1].n_changed == 0 and got[0, 1].coverage == 1.0
    assert got[1, 1].n_changed == 4 and got[1, 1].coverage >= 0.9 and got[1, 1].first_word in (7, 8)


def test_short_items_and_units(spark):
    got = leaks(spark, ["indeed the quick, tests ARE few!", "indeed the quick, tests are few!", "the quick tests were few", "it takes 30km and more"])
    assert set(got) == {(1, 2)}  # a capital inside a sentence is a name


def test_partial_copies_need_half_of_the_item(spark):
    words = ITEMS[0][1].split()
    got = leaks(spark, [" ".join(words[:15]), " ".join(words[:9]), "x " + " ".join(words[6:]) + " y"])
    assert set(got) == {(0, 1), (2, 1)}


def test_documents_table_against_exact_passages(spark):
    """Every document that holds an item word for word is found; the others share
    no eight words with any item."""
    items = {r.item_id: r.text for r in table(spark, SF001, "benchmark").collect()}
    texts = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    bare = lambda t: re.findall(r"[0-9a-zÀ-￿]+", (t or "").lower())
    found = {(r.doc_id, r.item_id) for r in op8_decontaminate(spark, SF001).collect()}
    held = {i: f" {' '.join(bare(t))} " for i, t in texts.items()}
    want = {(d, i) for d, t in held.items() for i, x in items.items() if f" {' '.join(bare(x))} " in t}
    assert want and want <= found
    runs = {}
    for i, x in items.items():
        w = bare(x)
        for k in range(len(w) - 7):
            runs.setdefault(" ".join(w[k : k + 8]), set()).add(i)
    for d, i in found - want:
        w = held[d].split()
        assert any(i in runs.get(" ".join(w[k : k + 8]), ()) for k in range(len(w) - 7))


def test_dropping_keeps_clean_documents(spark):
    rows = [(1, ITEMS[0][1], "en", "s", 1), (1, ITEMS[0][1], "en", "s", 1), (None, ITEMS[0][1], "en", "s", 1), (2, None, "en", "s", 1), (3, "clean", "en", "s", 1)]
    kept = decontaminate.drop_leaks(docs(spark, rows), bench(spark))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3] and set(CLASHES) <= set(kept.columns)


def test_empty_tables(spark):
    assert decontaminate.find_leaks(empty(spark), bench(spark)).count() == 0
    assert decontaminate.find_leaks(docs(spark), bench(spark, [])).count() == 0
    assert decontaminate.drop_leaks(docs(spark), bench(spark, [])).count() == docs(spark).count()


def all_leaks(spark, texts, items=ITEMS):
    rows = docs(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_all_leaks(rows, bench(spark, items)).collect()}
    kept = {r.doc_id for r in decontaminate.drop_leaks(rows, bench(spark, items)).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in got}
    return got


def test_verbatim_copies_in_any_case_and_place(spark):
    item, short = ITEMS[0][1], "What is the capital city of France?"
    wrapped = item.replace("leaves Boston", "leaves\nBoston").replace("reaches ", "reaches\n")
    got = all_leaks(spark, [item.lower(), item.upper(), wrapped, "He asked, " + short, "Q7 " + short, "the quick tests ARE few"], [*ITEMS, (7, short)])
    assert set(got) == {(0, 1), (1, 1), (2, 1), (3, 7), (4, 7), (5, 2)}
    assert all(r.coverage == 1.0 for r in got.values())


def test_one_contradicting_slot_costs_its_windows_only(spark):
    item = ITEMS[0][1]
    mixed = item.replace("reaches Denver", "reaches Paris")
    both = item.replace("Boston", "Denver").replace("30", "45")
    same = item.replace("30", "9").replace("7", "9")  # two slots, one value
    got = all_leaks(spark, [mixed, both, same])
    assert set(got) == {(0, 1), (1, 1), (2, 1)}
    assert got[0, 1].coverage >= 0.95 and got[1, 1].coverage == got[2, 1].coverage == 1.0
    assert got[2, 1].n_changed == 2


def test_the_value_that_stands_most_often_is_meant():
    window = lambda at, doc: {"item_at": at, "item_slots": [7] * len(at), "doc_slots": doc}
    assert decontaminate._meant([window([1, 4], [5, 7]), window([4, 9], [7, 5])]) == {7: 5}
    assert decontaminate._meant([window([1, 4], [5, 7])]) == {7: 7}  # a tie: the item's own
    assert decontaminate._meant([window([1, 4], [5, 6])]) == {7: 5}  # then the first


def test_alignments_of_one_item_are_put_together(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(250)]
    item = " ".join(words)
    quote = "as he said " + " ".join(words[40:140]) + " and went on"
    short = " ".join(words[40:52])  # 12 words
    inserted = " ".join(w + " really" if i in (83, 166) else w for i, w in enumerate(words))
    dropped = " ".join(w for i, w in enumerate(words) if i not in (83, 166))
    halves = " ".join(words[:60]) + " other words between " + " ".join(words[100:170])
    got = all_leaks(spark, [quote, short, inserted, dropped, halves, item], [(1, item)])
    assert set(got) == {(0, 1), (2, 1), (3, 1), (4, 1), (5, 1)}
    assert got[0, 1].n_covered == 100 and got[0, 1].first_word == 3
    assert got[2, 1].n_covered == 250 and got[3, 1].n_covered == 248 and got[4, 1].n_covered == 130


def test_texts_of_one_id_are_not_put_together(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(30)]
    rows = docs(spark, [(None, " ".join(words[:10]), "en", "s", 1), (None, " ".join(words[15:25]), "en", "s", 1)])
    assert decontaminate.find_all_leaks(rows, bench(spark, [(1, " ".join(words))])).count() == 0


def test_placeholders_and_short_items_are_found_verbatim(spark):
    series = "What comes next: " + " ".join(str(i) for i in range(2, 42))
    items = [(3, ITEMS[2][1]), (6, "two words"), (7, series), (8, "Oslo"), (9, "..."), (10, "")]
    texts = [
        "so " + series + " and on",
        "it is 12 14 16 18 20 22 24 26 28 30 then",
        "1 3 5 7 9 11 13 15 17 19 21 23",  # the same form, other values
        "here are Two words, and Two words again",
        "two other words",
        "from oslo.",
    ]
    got = all_leaks(spark, texts, items)
    assert set(got) == {(0, 7), (1, 3), (3, 6), (5, 8)}
    assert all(r.coverage == 1.0 for r in got.values())
