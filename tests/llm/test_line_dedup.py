import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tarmac.llm import line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(texts, k=2, least=20):
    lines = [(d, i, x) for d, t in enumerate(texts) for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\v\f\r")]
    places = defaultdict(list)
    for d, i, x in lines:
        places[x].append((d, i))
    label, near = {x: x for x in places}, Counter()

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    long = [x for x in places if len(x) >= least]
    for n, a in enumerate(long):
        for b in long[:n]:
            if abs(len(a) - len(b)) <= k and distance(a, b) <= k:
                near[a] += len(places[b])
                near[b] += len(places[a])
                label[root(a)] = root(b)
    first = {}
    for x in places:
        first[root(x)] = min(first.get(root(x), places[x][0]), min(places[x]))
    return sorted((d, i, *first[root(x)], len(places[x]) - 1 + near[x], first[root(x)] == (d, i)) for d, i, x in lines)


def check(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = line_dedup.line_classes(df, **options).collect()
    got = sorted((r.doc_id, r.line_no, r.first_id, r.first_line_no, r.n_links, r.kept) for r in rows)
    assert got == brute(texts, options.get("max_edits", 2))


def edited(seed, n_texts=70, alphabet="xyé "):
    draw = random.Random(seed)
    base = ["".join(draw.choice("abcdefgh ü") for _ in range(draw.randint(18, 60))) for _ in range(25)]
    texts = []
    for _ in range(n_texts):
        lines = []
        for _ in range(draw.randint(0, 5)):
            x = list(draw.choice(base))
            for _ in range(draw.choice([0, 0, 1, 2, 3])):
                p, kind = draw.randrange(len(x)), draw.random()
                if kind < 0.3:
                    x[p] = draw.choice(alphabet)
                elif kind < 0.6:
                    x.insert(p, draw.choice(alphabet))
                else:
                    del x[p]
            lines.append("".join(x))
        texts.append("\n".join(lines))
    return texts


def test_against_brute_force(spark):
    check(spark, edited(1))
    check(spark, edited(2), max_edits=1)
    check(spark, edited(3), max_edits=3)


def test_distance_in_the_band(spark):
    draw = random.Random(5)
    pairs = []
    for _ in range(400):
        a = "".join(draw.choice("abé") for _ in range(draw.randint(4, 30)))
        b = list(a)
        for _ in range(draw.randint(0, 5)):
            p = draw.randrange(len(b) + 1)
            b[p : p + draw.randint(0, 1)] = draw.choice(["", "c", "a"])
        pairs.append((a, "".join(b) or "c"))
    for k in (1, 2, 3):
        df = spark.createDataFrame(pairs, "a string, b string").where(f"abs(length(a) - length(b)) <= {k} AND length(b) >= {k}")
        out = df.select("a", "b", line_dedup.banded_distance(F.col("a"), F.col("b"), k).alias("d")).collect()
        assert out and all(min(r.d, k + 1) == min(distance(r.a, r.b), k + 1) for r in out)


def test_odd_rows(odd):
    rows = line_dedup.line_classes(odd).collect()
    assert all(r.line_no is not None for r in rows)
    kept = line_dedup.drop_repeated_lines(odd)
    assert kept.columns == odd.columns
    out = Counter((r.doc_id, r.text is None) for r in kept.collect())
    # the copy's only line is the first text's line, so that row goes; rows without words stay
    assert out[(3, True)] == 1 and out[(4, False)] == 1 and out[(5, False)] == 1 and out[(None, True)] == 1
    assert out[(1, False)] == 1 and out[(2, False)] == 1 and out[(7, False)] == 1 and out[(8, False)] == 0
    assert line_dedup.line_classes(odd.limit(0)).count() == 0
    assert line_dedup.drop_repeated_lines(odd.limit(0)).count() == 0


def test_text_is_put_together_again(spark):
    same = "this line stands in every text"
    texts = [f"{same}\n\nfirst body line of the text\n", f"{same}\nsecond body, another line\n\nend of two", f"{same}\n{same}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df).collect()}
    assert kept == {0: texts[0], 1: "second body, another line\n\nend of two"}
    whole = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df, drop_emptied=False).collect()}
    assert whole == {**kept, 2: ""}
