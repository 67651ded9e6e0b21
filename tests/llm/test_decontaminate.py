import random

from gradeloom.llm.decontaminate import find_leaks, without_leaks

DOCS, ITEMS = "doc_id long, text string, item_id string, h int", "item_id long, text string, w string"


def shingles(words, span):
    return {tuple(words[i : i + span]) for i in range(len(words) - span + 1)}


def brute(docs, items):
    out = set()
    for item_id, text, *_ in items:
        words = (text or "").lower().split()
        if not words:
            continue
        own = shingles(words, min(5, len(words)))
        for doc_id, doc, *_ in docs:
            held = shingles((doc or "").lower().split(), min(5, len(words)))
            n = len(own & held)
            if 100 * n >= 75 * len(own):
                out.add((doc_id, item_id, len(own), n))
    return out


def run(spark, docs, items):
    found = find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert len(found) == len({(r["doc_id"], r["item_id"]) for r in found})
    return {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in found}


def test_matches_brute_force_in_long_documents(spark):
    pick = random.Random(4)
    words = [f"v{i}" for i in range(300)]
    text = lambda n: " ".join(pick.choice(words) for _ in range(n))
    items = [(i, text(pick.choice([5, 9, 20, 60, 200])), "x") for i in range(30)]
    items += [(90, items[0][1], "same"), (91, "v1", "x"), (92, "V2 v3", "x"), (93, "", "x"), (94, None, "x")]
    docs = []
    for i in range(60):
        body = text(pick.choice([0, 3, 100, 5000])).split()
        if i % 2:
            part = items[pick.randrange(30)][1].split()
            for _ in range(pick.choice([0, 0, 1, 3])):
                part[pick.randrange(len(part))] = "changed"
            at = pick.randrange(len(body) + 1)
            body[at:at] = [w.upper() for w in part]
        docs.append((i, "  \n".join(body), "clash", 0))
    docs += [(70, None, "", 0), (71, "", "", 0)]
    assert run(spark, docs, items) == brute(docs, items)


def test_null_ids_repeats_and_empty_tables(spark):
    leak, clean = "q w e r t y u i o p", "a s d f g h j k l"
    docs = [(None, f"x {leak} y", "", 0), (3, f"x {leak} y", "", 0), (3, f"x {leak} y", "", 0), (4, clean, "", 0), (None, clean, "", 0)]
    items = [(1, leak, ""), (1, leak, "")]
    assert run(spark, docs, items) == {(None, 1, 6, 6), (3, 1, 6, 6)}
    assert run(spark, [], items) == set() and run(spark, docs, []) == set()
    frame = spark.createDataFrame(docs, DOCS)
    left = without_leaks(frame, spark.createDataFrame(items, ITEMS))
    assert left.columns == frame.columns and [r["doc_id"] for r in left.collect()] == [4]
