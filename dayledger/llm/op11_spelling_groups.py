"""Words that differ by one code point, found by a relational trie frontier.

The trie is a table: a node stands for a prefix (by its hash), an edge (node,
label, child) for the letters between two nodes. Letters on which no two words
part share one edge, so the number of levels is the number of partings on a path
and not the length of the longest word. Each word also stands reversed in a
second trie: of two words at one edit, the letters before the edit or those
after it make up half of the word at least, so every search may take the first
half of its word as given and look for the edit in the rest.

The frontier holds states (word, position, node, edits). It starts without an
edit at the nodes on the word's own path from its half on. There the word and its
neighbour part: a step joins the states with all other edges of their node and
replaces, inserts or deletes one letter; from then on the states follow the one
edge whose label equals the word's next letters, level by level, each level one
join with the edge table, written before the next. An edge knows the letters that
follow it and the lengths left to the ends of words below; states that these rule
out are not kept. A state at the end of its word
and at the end of another is a pair. Hashes name nodes; two prefixes of one hash
only merge their edges, which adds states but loses none, and every pair is
compared as text in the end.

A node has at most one edge a letter, so a frequent node widens the frontier by
the alphabet, never by the number of words below it; counts, nodes and edges are
aggregated before they shuffle. A word's form is its most frequent near word (ties: the smaller
in code-point order) if that is ``ratio`` times as frequent; roots follow by
pointer doubling.

Defined cases: a null or empty text has no words; a null doc_id stands as empty
text before the colon; rows that repeat a doc_id count each; a run from which its
only letter is deleted is no word; very long runs are words as any other; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import table, written

#: A letter of a word.
LETTER = "[A-Za-z\\u00C0-\\u00FF]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame, least_length: int, least_n: int, drop: int) -> DataFrame:
    """(word, n): the runs of letters of all texts, of which the documents of one
    hash in ``drop`` lose a letter."""
    # a run that is too short is passed over inside the pattern and never becomes a row
    run = F.lit(f"{LETTER}{{{max(least_length, 1)},}}")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col("text").cast("string"), run, F.lit(0))).alias("run"))
    # only a run with a capital and other letters than ASCII's pays for the translation
    lower = (F.when(F.octet_length("run") == F.length("run"), F.lower("run"))
             .when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, UPPER.lower())).otherwise(F.col("run")))
    runs = runs.select("id", lower.alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    gone = "cast(h % length(run) as int)"
    word = F.when(F.col("h") % drop == 0, F.expr(f"concat(substring(run, 1, {gone}), substring(run, {gone} + 2))")).otherwise(F.col("run"))
    return (hashed.select(word.alias("word")).where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n))


#: The node of the first ``i`` letters of ``s`` in the trie ``side``.
NODE = "xxhash64(side, substring(s, 1, {i}))"
#: Lengths from this one on share a bit.
FAR = 62


def _both_sides(words: DataFrame) -> DataFrame:
    """Each word (side 0) and its reverse (side 1): s, side, size."""
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("s")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("s")))
    return words.select(F.inline(sides).alias("side", "s"), F.length("word").alias("size"))


def spines(words: DataFrame) -> DataFrame:
    """Each word's path from its half on: the positions of nodes where words
    part, and its end (``steps``, ascending), on either side."""
    both = _both_sides(words).withColumn("id", F.xxhash64("s"))
    # a partner may be longer by one letter, so paths begin at the half of the word without one
    places = both.select("id", "side", "s", F.explode(F.sequence(F.expr("(size - 1) div 2"), F.col("size"))).alias("i"))
    places = places.select("id", "side", "i", F.expr(NODE.format(i="i")).alias("node"), F.ascii(F.expr("substring(s, i + 1, 1)")).alias("letter"))
    parting = (places.groupBy("node").agg(F.min("letter").alias("x"), F.max("letter").alias("y")).where("x < y").select("node"))
    steps = (places.select("id", "side", "i", "node").join(parting, "node", "left_semi")
             .groupBy("id", "side").agg(F.sort_array(F.collect_set("i")).alias("steps")))
    end = F.array_union("steps", F.array("size"))
    return both.join(steps, ["id", "side"]).select("side", "s", "size", F.filter(end, lambda i: i <= F.col("size")).alias("steps"))


def trie(paths: DataFrame) -> DataFrame:
    """(node, label, child, ahead) of all paths, each edge once. ``ahead`` maps
    the next letter after the child (empty at the end of a word) to the set of
    lengths that are left to the end, as bits."""
    letter = F.expr("substring(s, at + 1, 1)")
    left = F.expr(f"shiftleft(1L, least(size - at, {FAR}))")
    ahead = (paths.select("side", "s", "size", F.explode("steps").alias("at"))
             .select(F.expr(NODE.format(i="at")).alias("child"), letter.alias("letter"), left.alias("left"))
             .groupBy("child", "letter").agg(F.bit_or("left").alias("left"))
             .groupBy("child").agg(F.map_from_entries(F.collect_list(F.struct("letter", "left"))).alias("ahead")))
    pairs = paths.select("side", "s", F.inline(F.arrays_zip(F.col("steps").alias("a"), F.expr("slice(steps, 2, size(steps))").alias("b"))).alias("a", "b"))
    edges = pairs.where("b is not null").select(
        F.expr(NODE.format(i="a")).alias("node"), F.expr("substring(s, a + 1, b - a)").alias("label"),
        F.expr(NODE.format(i="b")).alias("child")).distinct()
    return edges.join(ahead, "child").select("node", F.substring("label", 1, 1).alias("letter"), "label", "child", "ahead")


def _leads(at: str) -> str:
    """Whether some word below the child has the next letter and the length that
    the state's word has from position ``at`` on."""
    return f"coalesce(shiftright(ahead[substring(s, {at} + 1, 1)], least(size - {at}, {FAR})) & 1, 0) = 1"


def _started(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """The states with one edit that the states without an edit lead to."""
    states = (paths.select("side", "s", "size", F.explode("steps").alias("at")).where("at >= size div 2")
              .select("side", "s", "size", "at", F.expr(NODE.format(i="at")).alias("node")))
    shorter = states.where("at = size - 1").withColumn("at", F.col("size"))  # without its last letter
    # what a state or an edge knows alone is cut before they meet, as there are many more pairs
    here = states.select("*", F.expr("substring(s, at + 1, 1)").alias("own"), F.expr("substring(s, at + 1)").alias("rest"),
                         F.expr("substring(s, at + 2)").alias("later"))
    there = edges.select("*", F.expr("substring(label, 2)").alias("tail"), F.length("label").alias("letters"))
    met = here.join(there, "node").where("letter <> own")
    to = {"at + letters": "at < size and startswith(later, tail)",  # the first letter replaced,
          "at + letters - 1": "startswith(rest, tail)",  # or inserted
          "at + 1 + letters": "startswith(later, label)"}  # or the word's own deleted
    ends = F.array(*[F.expr(f"case when {how} and {_leads(f'({end})')} then {end} end") for end, how in to.items()])
    more = met.select("side", "s", "size", F.explode(ends).alias("at"), F.col("child").alias("node")).where("at is not null")
    return shorter.select(*more.columns).union(more)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of the (written) words at exactly one edit, both ways round."""
    paths = written(spines(words), "trie-paths")
    edges = written(trie(paths), "trie-edges")
    ended = []
    states = written(_started(paths, edges), "trie-states")
    while True:
        ended.append(states.where("at = size").select("side", "s", "node"))
        going = states.where("at < size")
        if going.isEmpty():
            break
        end = "(at + length(label))"
        going = going.withColumn("letter", F.expr("substring(s, at + 1, 1)")).join(edges, ["node", "letter"])
        states = written(going.where("label = substring(s, at + 1, length(label))").where(_leads(end)).select(
            "side", "s", "size", F.expr(end).alias("at"), F.col("child").alias("node")), "trie-states")
    found = ended[0]
    for more in ended[1:]:
        found = found.union(more)
    own = F.when(F.col("side") == 0, F.col("s")).otherwise(F.reverse("s"))
    names = _both_sides(words).select(F.xxhash64("side", "s").alias("node"), own.alias("near"))
    return (found.select("node", own.alias("word")).join(names, "node").where(F.levenshtein("word", "near", 1) == 1)
            .select("word", "near").distinct())


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a written table (word, root) of each word's form."""
    while True:
        on = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(forms.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        forms = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return forms


def spelling_groups(docs: DataFrame, least_length: int = 5, least_n: int = 3, ratio: int = 2, drop: int = 97) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word. ``docs``: doc_id, text."""
    words = written(word_counts(docs, least_length, least_n, drop), "words")
    near = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    leads = -F.col("best.less") >= ratio * F.col("n")
    known = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(leads, F.col("best.near")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n")), "forms")
    last = roots(known.where("form is not null").select("word", F.col("form").alias("root")))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of five letters and three occurrences, its near words and its root."""
    return spelling_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
