import math
import random
from collections import Counter

import pytest

from tests.llm.messy import ROWS, messy, nothing, rows
from tickwell.llm import leaks

ITEMS = "item_id long, text string"


def plain_scores(items, passage):
    """BM25 of every item for a passage, over the item's score with itself."""
    bags = [Counter(i.words) for i in items]
    mean = sum(len(i.words) for i in items) / len(items)
    df = Counter(w for b in bags for w in b)

    def gain(bag, word, n):
        idf = math.log1p((len(items) - df[word] + 0.5) / (df[word] + 0.5))
        tf = bag[word]
        return idf * tf * (leaks.K1 + 1) / (tf + leaks.K1 * (1 - leaks.B + leaks.B * n / mean))

    out = []
    for item, bag in zip(items, bags):
        n = len(item.words)
        own = sum(gain(bag, w, n) for w in bag)
        out.append(sum(gain(bag, w, n) for w in set(passage) & set(bag)) / own)
    return out


def some_items(pick, n):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(pick.choice(words) for _ in range(pick.randint(6, 20))) + ". Answer " + " ".join(pick.choice(words) for _ in range(4)) + "." for _ in range(n)]
    return words, [leaks.Item(i, *leaks.question_and_answer(t)) for i, t in enumerate(texts)], texts


def test_search_finds_all_above_the_threshold():
    pick = random.Random(1)
    words, items, texts = some_items(pick, 45)
    index = leaks.Index(items)
    for _ in range(60):
        text = " ".join([" ".join(pick.choice(words) for _ in range(pick.randint(0, 90))), pick.choice(texts)])
        tokens = leaks.words_of(text)
        got = {(start, index.items[at].id): score for start, _, at, score in index.search(tokens, 0.6)}
        want = {}
        for k in range(max(1, -(-len(tokens) // index.stride) - 1)):
            start = k * index.stride
            for item, score in zip(items, plain_scores(items, tokens[start : start + 2 * index.stride])):
                if score >= 0.6:
                    want[start, item.id] = score
        # Sums in another order may fall on either side of the threshold itself.
        assert all(abs({**got, **want}[k] - 0.6) < 1e-5 for k in got.keys() ^ want.keys())
        assert all(abs(got[k] - want[k]) < 1e-4 for k in got.keys() & want.keys())


def test_leaks_are_found_wherever_they_stand(spark):
    pick = random.Random(2)
    words, items, texts = some_items(pick, 30)
    fresh = [f"v{i}" for i in range(500)]

    def filler(n):
        return " ".join(pick.choice(fresh) for _ in range(n))

    docs, want = [], set()
    for i in range(120):
        k = pick.randrange(len(texts))
        if i % 3 == 0:
            docs.append((i, f"{filler(pick.randint(0, 200))} {texts[k].upper()} {filler(pick.randint(0, 200))}"))
            want.add((i, k))
        elif i % 3 == 1:
            docs.append((i, filler(300)))
        else:
            # The question alone is not a leak.
            docs.append((i, filler(100) + " " + b" ".join(items[k].question).decode() + " " + filler(30)))
    table = spark.createDataFrame(list(enumerate(texts)), ITEMS)
    found = leaks.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), table)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_many_items_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(leaks, "ITEMS_AT_ONCE", 7)
    texts = [f"item number {i} asks about thing{i} of kind{i}. Answer is reply{i} of sort{i}." for i in range(30)]
    docs = spark.createDataFrame([(i, "x " * i + t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = leaks.find_leaks(docs, spark.createDataFrame(list(enumerate(texts)), ITEMS))
    assert {(i, i) for i in range(30)} <= {(r["doc_id"], r["item_id"]) for r in found.collect()}


def test_messy_documents_and_items(spark):
    items = [(1, ROWS[0][1]), (2, None), (None, "item without an id but words enough to be found"), (3, ""), (4, "short one"), (1, ROWS[0][1])]
    table = spark.createDataFrame(items, ITEMS).withColumns({c: leaks.F.lit("x") for c in ("doc_id", "score", "parts", "block")})
    found = leaks.find_leaks(messy(spark), table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (3, 1)}
    left = leaks.drop_leaks(messy(spark), table)
    assert left.columns == messy(spark).columns and left.count() == len(ROWS) - 2
    none = spark.createDataFrame([], ITEMS)
    assert leaks.find_leaks(messy(spark), none).count() == 0
    assert leaks.find_leaks(nothing(spark), table).count() == 0
    assert leaks.drop_leaks(messy(spark), none).count() == len(ROWS)


def test_question_and_answer_columns(spark):
    items = spark.createDataFrame([(1, "what is the colour of the sky", "it is blue today")], "item_id long, q string, a string")
    docs = spark.createDataFrame(
        [(1, "what is the colour of the sky? it is blue today"), (2, "what is the colour of the sky? no idea")],
        "doc_id long, text string",
    )
    found = leaks.find_leaks(docs, items, question_col="q", answer_col="a", item_text_col="q").collect()
    assert [r["doc_id"] for r in found] == [1]


def test_items_without_an_answer_column_are_held_against_their_whole_text(spark):
    words = [f"w{i}" for i in range(40)]
    items = [(1, f"{' '.join(words[:24])}. {' '.join(words[24:28])}, inth. Er."), (2, f"{' '.join(words[10:34])}. {' '.join(words[34:])}.")]
    body = items[0][1].rsplit(" ", 1)[0]
    docs = [
        (1, "before it " + body + " and what follows is something else"),  # all but the last fragment
        (2, "before it " + items[0][1].replace("w26", "other")),  # one word changed
        (3, "before it " + items[0][1].replace("Er.", "Ti.")),  # another fragment
        (4, "before it " + items[1][1].replace("w37", "other")),  # one word of the last sentence changed
        (5, "before it " + " ".join(words[:9])),  # too little
        (6, "before it " + " ".join(words[10:34])),  # the question alone
    ]
    table = spark.createDataFrame(items, ITEMS)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in leaks.find_leaks(df, table).collect()}
    assert {(1, 1), (2, 1), (3, 1), (4, 2)} <= found and not {d for d, _ in found} & {5, 6}
    assert {r["doc_id"] for r in leaks.drop_leaks(df, table).collect()} == {5, 6}


def test_words_in_order():
    pick = random.Random(3)
    for _ in range(200):
        a, b = ([pick.choice([b"a", b"b", b"c", b"d"]) for _ in range(pick.randint(0, 12))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            row, old = [0], row
            for j, y in enumerate(b):
                row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
        assert leaks.in_order(a, b) == row[-1]


def test_short_items_and_unspaced_scripts(spark):
    items = [(1, "Short one."), (2, "水の沸点は百度です。"), (3, "น้ำเดือดที่ร้อยองศา"), (4, "Paris"), (5, "月球"), (6, " .. "), (7, "a b c d")]
    docs = [
        (1, "this is a short one, is it"),
        (2, "one short"),
        (3, "前置きです水の沸点は百度です。続き"),
        (4, "ก่อน น้ำเดือดที่ร้อยองศา หลัง"),
        (5, "in paris, a b c e"),
        (6, "关于月球的文章"),
        (7, "关于月亮的文章 a b c d"),
        (8, "水 comes to a boil"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = leaks.find_leaks(df, spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (3, 2), (4, 3), (5, 4), (6, 5), (7, 7)}
    left = leaks.drop_leaks(df, spark.createDataFrame(items, ITEMS))
    assert {r["doc_id"] for r in left.collect()} == {2, 8}


def test_scores_do_not_depend_on_the_number_of_indexes(spark, monkeypatch):
    def item(i):
        return " ".join([f"subject{i % 40} asks about thing{i} and part{i % 7}", "often " * (i % 5), f"so. Answer {i} is word{i * 31 % 97} here now."])

    items = spark.createDataFrame([(i, item(i)) for i in range(2_001)], "item_id long, text string")
    docs = [(i, " ".join([f"before {i}", item(i * 20), f"and after {i}"])) for i in range(60)]
    docs += [(100 + i, " ".join(item(i * 30).split()[:-2]) + " more than this") for i in range(30)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    several = rows(leaks.find_leaks(docs, items))
    monkeypatch.setattr(leaks, "ITEMS_AT_ONCE", 10_000)
    assert several == rows(leaks.find_leaks(docs, items)) and len(several) >= 60


@pytest.mark.parametrize("slice_terms", [1, 50])
def test_bounds_by_slices(monkeypatch, slice_terms):
    items = [leaks._item(i, [f"question number{i} of topic{i % 3} is long enough. The answer is value{i} exactly so."]) for i in range(30)]
    index = leaks.Index(items, block=4)
    words = leaks.words_of(" ".join(f"filler{i} " * 9 + b" ".join(items[i % 30].words).decode() for i in range(90)))
    whole = list(index.search(words, 0.6))
    monkeypatch.setattr(leaks, "SLICE_TERMS", slice_terms)
    assert list(index.search(words, 0.6)) == whole and len({j for *_, j, _ in whole}) == 30
