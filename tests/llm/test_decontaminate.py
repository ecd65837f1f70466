"""Template windows against planted passages."""
import random

from pyspark.sql import functions as F

from shopstat.llm.decontaminate import contaminated, drop_contaminated

QUESTION = "If Alice buys 12 apples for 3 dollars each and Bob pays 40 dollars, how much change does Alice get back from Bob after 12 days?"
CHANGED = "If Maria buys 75 apples for 8 dollars each and Tom pays 99 dollars, how much change does Maria get back from Tom after 75 days?"
MIXED_UP = "If Maria buys 75 apples for 8 dollars each and Tom pays 99 dollars, how much change does Tom get back from Maria after 31 days?"


def test_exact_changed_and_inconsistent(table):
    rng = random.Random(2)
    noise = lambda n: " ".join(rng.choice(["river", "stone", "cloud", "paper", "green", "seven", "walks", "under"]) for _ in range(n)) + ". "
    docs = [(1, noise(60) + QUESTION + " " + noise(900)), (2, noise(5) + CHANGED), (3, noise(10) + MIXED_UP), (4, noise(4000)), (5, None), (6, ""), (7, "  \n"),
            (None, QUESTION), (8, " ".join(QUESTION.split()[:9])), (9, "Name Other Third " * 30), (10, "5 6 7 8 9 10 11 12 13 14 15 16"), (2, CHANGED), (11, "short item of only seven words here")]
    docs += [(100 + i, noise(3) + QUESTION) for i in range(120)]
    bench = [(70, QUESTION), (71, None), (72, ""), (73, "too short"), (74, "short item of only seven words here"), (75, "Name Other Third " * 8)]
    df, items = (table(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")),
                 table(bench, "item_id long, text string").withColumn("doc_id", F.lit(1)))
    got = {(r.doc_id, r.item_id): r for r in contaminated(df, items).collect()}
    assert set(got) == {(1, 70), (2, 70), (None, 70), (9, 75), (11, 74)} | {(100 + i, 70) for i in range(120)}
    assert got[2, 70].reparameterised and not got[1, 70].reparameterised and got[1, 70].matched_words <= got[1, 70].item_words
    left = drop_contaminated(df, items)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6, 7, 8, 10]


def test_empty_tables(table):
    df, items = table([(1, QUESTION)], "doc_id long, text string"), table([(1, QUESTION)], "item_id long, text string")
    assert contaminated(df, items.limit(0)).count() == 0 and contaminated(df.limit(0), items).count() == 0


def test_found_items_match_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(d + "/documents.parquet"), spark.read.parquet(d + "/benchmark.parquet")
    plain = lambda t: " " + " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split()) + " "
    texts = [(r.doc_id, plain(r.text)) for r in docs.collect()]
    want = {(i, r.item_id) for r in items.collect() for i, t in texts if plain(r.text) in t}
    assert want <= {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}


def found(table, docs, bench):
    df, items = table(list(enumerate(docs)), "doc_id long, text string"), table(list(enumerate(bench)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in contaminated(df, items).collect()}


def test_verbatim_copies_full_of_placeholders_and_short_items(table):
    sums = "12 + 30 = 42, 15 + 9 = 24, 8 + 77 = 85, 4 + 4 = 8, 61 + 5 = 66"
    names = "the list Anna Bert Cora Dora Emil Fritz Gerd Hans Ida Jens Karl Lena Max Nora Otto"
    got = found(table, [f"so we write {sums} here", f"look at {names} again", "he asked what is two plus two and left", sums.replace("2", "3"), "a price of 5 % only", "a price of 5 $ only"],
                [sums, names, "What is two plus two?", "price of 5 %"])
    assert set(got) == {(0, 0), (1, 1), (2, 2), (4, 3)} and not any(r.reparameterised for r in got.values())


def test_one_conflict_leaves_the_rest_of_a_passage(table):
    long = "take 5 grains of salt and stir them slowly into the warm water until nothing is left to see then wait a while and add another 5 grains to it"
    pears = "If a farmer sells 3 baskets of pears and 4 crates of plums, how many does the farmer sell?"
    got = found(table, [long.replace("another 5", "another 6"), pears.replace("3", "5").replace("4", "5"), QUESTION.replace("Alice get", "Bob get"),
                        CHANGED.replace("after 75", "after 31"), MIXED_UP], [long, pears, QUESTION])
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 2)}
    assert {k: r.reparameterised for k, r in got.items()} == {(0, 0): False, (1, 1): True, (2, 2): False, (3, 2): True}


def test_a_change_of_case_hides_nothing(table):
    german = ("heute kauft der Bauer auf dem Markt in der Stadt große Äpfel und süße Birnen für die Kinder der Straße, "
              "dann fährt der Wagen mit dem Pferd durch das Tor zum Haus der Familie am Fluß")
    got = found(table, [german.upper(), german.lower(), german], [german])
    assert set(got) == {(0, 0), (1, 0), (2, 0)} and {r.matched_words for r in got.values()} == {len(german.split())}
