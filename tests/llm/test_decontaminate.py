"""Re-parameterised benchmark items: other names, numbers and single words; recall on plants."""

import random

from pyspark.sql import functions as F

from shoprank.llm.decontaminate import leaks

ITEMS = ["Tom has 5 apples. Tom gives 2 apples to Mary. How many apples are left with Tom?",
         "Mary walks to the old market with John and buys 7 oranges for the children of Anna.",
         "What is the name of the largest lake that lies wholly inside one country of Africa?",
         "A train leaves Berlin at 9 and reaches Paris at 17. How many hours does the train need in all?"]
PLANTS = [(0, "Bob has 5 apples. Bob gives 2 apples to Mary. How many apples are left with Bob?"),
          (0, "Bob Lee has 9 apples. Bob Lee gives 4 apples to Jane. How many apples are left with Bob Lee?"),
          (1, "Mary Smith walks to the old market with John and buys 7 oranges for the children of Anna."),
          (2, "What is the name of the greatest lake that lies wholly inside one country of Africa?"),
          (3, "A train leaves New York at 8 and reaches Los Angeles at 23. How many hours does the train need in all?")]
CLEAN = ["Tom has a dog. Mary has 5 cats. How many animals are there with Tom, and how many with Mary and her brother?",
         "The largest lake lies in the north, and a market is held there every week.",
         "A train leaves the station. It is late, as many trains are in the winter of the year, they say."]


def test_other_names_and_single_words_are_found(spark):
    rows = [(k, f"Some words before it. {t} Some words after it.") for k, (_, t) in enumerate(PLANTS)]
    rows += [(100 + k, t) for k, t in enumerate(CLEAN)]
    found = leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                  spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, i) for k, (i, _) in enumerate(PLANTS)}


def test_recall_on_reparameterised_plants(spark):
    dice = random.Random(11)
    plain = [f"w{a}{b}" .translate(str.maketrans("0123456789", "bcdfghklmn")) for a in "0123456789" for b in range(60)]
    people = ["Tom", "Mary", "John Smith", "Anna", "Peter van", "Olga Maria Lind", "Carl", "Ida"]

    def parts():
        kinds = [dice.choice("wwwwwnp") for _ in range(dice.randint(14, 40))]
        return [dice.choice(plain) if k == "w" else dice.choice("abc") + "#" if k == "n" else dice.choice("xyz") + "@" for k in kinds]

    def fill(words):
        numbers = dict(zip("abc", dice.sample(range(2, 900), 3)))
        names = dict(zip("xyz", dice.sample(people, 3)))
        out = [str(numbers[w[0]]) if w.endswith("#") else names[w[0]] if w.endswith("@") else w for w in words]
        return " ".join([out[0][0].upper() + out[0][1:], *out[1:]]) + "."

    templates = [parts() for _ in range(150)]
    items = [(k, fill(t)) for k, t in enumerate(templates)]
    noise = lambda: " ".join(dice.choice(plain) for _ in range(60))
    docs = [(k, f"{noise()}. {fill(t)} {noise()}") for k, t in enumerate(templates)] + [(1000 + k, noise()) for k in range(150)]
    found = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert not {p for p in got if p[0] != p[1]}
    assert len(got) >= 0.9 * len(templates), len(got)


def test_empty_and_null_texts_with_extra_columns(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, ITEMS[0], 3), (3, ITEMS[1] + " x" * 200_000, 4)], "doc_id long, text string, hash int")
    items = spark.createDataFrame(list(enumerate([*ITEMS, None, ""])), "item_id long, text string").withColumn("folded", F.lit(1))
    assert {(r["doc_id"], r["item_id"]) for r in leaks(docs, items).collect()} == {(None, 0), (3, 1)}
