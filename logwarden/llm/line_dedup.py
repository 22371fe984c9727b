"""Repeated runs: of words by hashes that double in length, of whole lines by distributed prefix doubling over line ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.llm.common import SPACES, WORD, in_bitmap, key_bitmap, numbered, stored

MIN_WORDS = 50
BITMAP_BUCKETS = 1024
#: A text may be cut after a word that ends in one of these, if the next AHEAD words do not.
CUTS = ".,;:!?%05yg"
AHEAD = 2


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _doc_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.octet_length(F.coalesce(text, F.lit(""))))


def line_table(docs: DataFrame, order: DataFrame) -> DataFrame:
    """(pos, line, id, w) of every line with words in ``docs`` (doc_id, key, text), stored; ``order`` numbers the documents.

    ``pos`` is the document's number in the order of (doc_id, key) times 2^32 plus the line's number among the lines
    with words; ``line`` its number among all; ``id`` a hash of the line without white space at its ends.
    """
    solid = F.filter(F.transform(_lines(F.col("text")), lambda x, i: F.struct(i.alias("line"), F.trim(x, F.lit(SPACES)).alias("s"))), lambda x: x["s"] != "")
    body = docs.select("doc_id", "key", F.posexplode(solid).alias("at", "x")).select(
        "doc_id", "key", "at", F.col("x.line").alias("line"), F.xxhash64("x.s").alias("id"), F.regexp_count("x.s", F.lit(WORD)).alias("w"))
    same = body["doc_id"].eqNullSafe(order["doc_id"]) & (body["key"] == order["key"])
    placed = body.join(order, same).select((F.shiftleft("row", 32) + F.col("at")).alias("pos"), "line", "id", "w")
    # rows that agree in id and text are one document
    return stored(placed.groupBy("pos").agg(F.first("line").alias("line"), F.first("id").alias("id"), F.first("w").alias("w")), "lines")


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(start, n) of the shortest runs of at least ``min_words`` words that start, or end, at each line.

    These cover every longer run: a line of a repeated run lies in a window that is part of the run.  As a window's
    length depends on its words only, equal windows have equal lengths; and with one word a line at least, no window
    is longer than ``min_words`` lines.
    """
    doc = Window.partitionBy(F.shiftright("pos", 32))
    summed = lines.select("pos", "w", F.sum("w").over(doc.orderBy("pos")).alias("upto"))
    summed = summed.withColumn("before", F.col("upto") - F.col("w"))
    # before(j) >= before(p) + min_words: the window from p ends at j - 1; a row for the document's end closes the list
    ends = summed.groupBy(F.shiftright("pos", 32).alias("_doc")).agg((F.max("pos") + 1).alias("pos"), F.max("upto").alias("before"))
    rows = summed.select("pos", "before").union(ends.select("pos", "before"))
    later = doc.orderBy(F.col("before").desc()).rangeBetween(Window.unboundedPreceding, -min_words)
    earlier = doc.orderBy("before").rangeBetween(Window.unboundedPreceding, -min_words)
    both = rows.select("pos", F.min("pos").over(later).alias("stop"), F.max("pos").over(earlier).alias("start"))
    found = both.where("stop IS NOT NULL").select(F.col("pos").alias("start"), (F.col("stop") - F.col("pos")).alias("n")).union(
        both.where("start IS NOT NULL").select("start", (F.col("pos") - F.col("start")).alias("n")))
    return found.distinct()


def suffix_ranks(lines: DataFrame, longest: int) -> list[DataFrame]:
    """For k = 0, 1, ...: (pos, rank) of the places whose run of 2^k lines occurs at least twice, while there are any.

    The rank is the run's place in the sorted order of such runs: the order of the suffix array as far as 2^k lines
    tell.  Places of one rank are an interval of the array whose longest common prefix is at least 2^k.  A round
    doubles the length by joining each place with the one 2^k lines on; a run with a half that occurs once occurs
    once itself, so such places drop out and the tables shrink.
    """
    counts = stored(lines.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "line-ids")
    bits = stored(key_bitmap(counts, "id", BITMAP_BUCKETS), "line-bits")
    maybe = in_bitmap(lines.select("pos", "id"), "id", bits, BITMAP_BUCKETS, "maybe").where("maybe").select("pos", "id")
    # the order of line ids is that of their hashes
    levels = [stored(maybe.join(counts, "id").select("pos", F.col("id").alias("rank")), "rank")]
    while 2 ** len(levels) <= longest and not levels[-1].isEmpty():
        half, length = levels[-1], 2 ** (len(levels) - 1)
        right = half.select((F.col("pos") - length).alias("pos"), F.col("rank").alias("right"))
        pairs = stored(half.join(right, "pos"), "rank-pairs")
        classes = numbered(pairs.groupBy("rank", "right").agg(F.count("*").alias("n")).where("n > 1").select("rank", "right"), ["rank", "right"], "rank-order", "new")
        levels.append(stored(pairs.join(stored(classes, "rank-classes"), ["rank", "right"]).select("pos", F.col("new").alias("rank")), "rank"))
    return levels


def repeated_windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(start, n, first, copies) of the windows that occur more than once; first is the earliest start of the copies."""
    levels = suffix_ranks(lines, min_words)
    found = stored(windows(lines, min_words), "line-windows")
    k = F.floor(F.log2("n") + 1e-9).cast("int")
    asked = found.withColumn("k", k).withColumn("tail", F.col("start") + F.col("n") - F.expr("cast(power(2, k) as long)"))
    ranks = levels[0].withColumn("k", F.lit(0))
    for i, level in enumerate(levels[1:], 1):
        ranks = ranks.union(level.withColumn("k", F.lit(i)))
    # two runs of 2^k lines, the first and the last of the window, name it
    head = ranks.select(F.col("pos").alias("start"), "k", F.col("rank").alias("a"))
    last = ranks.select(F.col("pos").alias("tail"), "k", F.col("rank").alias("b"))
    named = stored(asked.join(head, ["start", "k"]).join(last, ["tail", "k"]).select("start", "n", "a", "b"), "line-named")
    groups = named.groupBy("n", "a", "b").agg(F.min("start").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    return named.join(stored(groups, "line-groups"), ["n", "a", "b"]).select("start", "n", "first", "copies")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_lines, deleted_lines (their numbers from 0), deleted_words and text without them.

    A run of consecutive lines with at least ``min_words`` words that occurs earlier, in an earlier document or earlier
    in the same one (documents in the order of id, null first, then of a hash of the text), is deleted; its first copy
    stays.  Lines are compared without white space at their ends; lines without words are passed over by the comparison
    and stay.  Runs do not cross documents and may overlap.

    A null text is an empty one: one line, nothing deleted.  Rows that agree in id and text are one document here and get
    the same result.  Other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), _doc_key(F.col(text_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = texts.groupBy("doc_id", "key").agg(F.count("*").alias("_rows")).select("doc_id", "key")
    order = stored(numbered(order, ["doc_id", "key"], "line-docs"), "line-order")
    lines = line_table(texts, order)
    later = repeated_windows(lines, min_words).where("first < start")
    gone = later.select(F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos")).distinct()
    # back from places to documents
    placed = gone.join(lines.select("pos", "line", "w"), "pos")
    by_doc = placed.groupBy(F.shiftright("pos", 32).alias("row")).agg(F.sort_array(F.collect_list("line")).alias("gone"), F.sum("w").alias("words"))
    return _without(texts, stored(by_doc, "line-gone"), order, id_col)


def _without(texts: DataFrame, gone: DataFrame, numbers: DataFrame, id_col: str) -> DataFrame:
    """Only texts that may lose lines are shuffled to the join; a bitmap lets the others pass."""
    named = stored(gone.join(numbers, "row").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "gone", "words"), "line-named-gone")
    bits = stored(key_bitmap(named, "_key", BITMAP_BUCKETS), "line-doc-bits")
    flagged = in_bitmap(texts, "key", bits, BITMAP_BUCKETS, "maybe")
    count = F.size(_lines(F.col("text"))).cast("long")
    untouched = flagged.where("NOT maybe").select(
        F.col("doc_id").alias(id_col), count.alias("n_lines"), F.array().cast("array<int>").alias("deleted_lines"), F.lit(0).cast("long").alias("deleted_words"), "text")
    some = flagged.where("maybe")
    joined = some.join(named, some["doc_id"].eqNullSafe(named["_id"]) & (some["key"] == named["_key"]), "left")
    every = F.sequence(F.lit(0), count.cast("int") - 1)
    kept = F.array_except(every, F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at(F.col("_lines"), i + 1)), "\n"))
    joined = joined.select("*", F.inline(F.array(F.struct(_lines(F.col("text")).alias("_lines")))))  # split once
    changed = joined.select(
        F.col("doc_id").alias(id_col), count.alias("n_lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("deleted_lines"),
        F.coalesce("words", F.lit(0)).cast("long").alias("deleted_words"), text.alias("text"))
    return untouched.union(changed)


def _joined(a: Column, shift: int, merge) -> Column:
    """``merge`` of each element with the one ``shift`` places on, as far as there is one."""
    n = F.greatest(F.size(a) - shift, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(shift + 1), n), merge)


def _once(df: DataFrame, keep: list[str], *columns: Column) -> DataFrame:
    """``keep`` and ``columns``, which are worked out once however often and where they are read."""
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def _grams(texts: DataFrame, min_words: int) -> DataFrame:
    """Adds ``units``, the text cut at some of its words, their ``sizes`` in words and hashes (``marks``), and ``seams``.

    A text is cut after a word that ends in one of ``CUTS``, unless one of the next ``AHEAD`` words does as well.  So
    equal runs of words are cut alike but for their ends, whatever stands around them.  ``seams`` (lo, hi, words, last)
    are the pairs of neighbours so long that ``min_words`` words within them may hold no whole unit.
    """
    keep = [c for c in texts.columns if c != "text"]
    # one space between words; white space other than blanks and line ends is rare
    rare = [c for c in SPACES if c not in " \n"]
    some = F.lit(False)
    for c in rare:
        some = some | F.contains("text", F.lit(c))
    spaced = F.when(some, F.translate("text", "".join(rare), " " * len(rare))).otherwise(F.col("text"))
    out = _once(texts, keep, F.trim(F.replace(spaced, F.lit("\n"), F.lit(" "))).alias("_x"))
    plain = F.when(F.contains("_x", F.lit("  ")), F.regexp_replace("_x", "  +", " ")).otherwise(F.col("_x"))
    cut = F.split(plain, rf" (?<=[{CUTS}] )(?=(?:[^ ]++(?<![{CUTS}])(?: |\z)){{{AHEAD}}})")
    out = _once(out, keep, F.when(F.col("_x") == "", F.array().cast("array<string>")).otherwise(cut).alias("units"))
    size = lambda u: F.octet_length(u) - F.octet_length(F.replace(u, F.lit(" "), F.lit(""))) + 1
    out = _once(out, [*keep, "units"], F.transform("units", size).alias("sizes"), F.transform("units", lambda u: F.xxhash64(u)).alias("marks"))
    final = F.size("sizes") - 1
    right = lambda i: F.least(i + 1, final)
    words = lambda i: F.get("sizes", i) + F.when(i < final, F.get("sizes", i + 1)).otherwise(0)
    at = F.when(final >= 0, F.sequence(F.lit(0), F.greatest(final - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    wide = F.filter(at, lambda i: words(i) + (AHEAD - 1) >= min_words)
    return out.withColumn("seams", F.transform(wide, lambda i: F.struct(
        i.alias("lo"), right(i).alias("hi"), words(i).alias("words"), F.get("sizes", right(i)).alias("last"))))


def _regions(found: DataFrame, min_words: int) -> DataFrame:
    """(key, spans): neighbouring rows of ``found`` (key, lo, hi, words, last) as one, where they hold ``min_words`` words.

    Rows that share a seam, the place between two units, are neighbours; each takes in one unit more at most.
    """
    a = F.col("a")
    fresh = lambda x, i: (i == 0) | (x["lo"] >= F.get(a, i - 1)["hi"])
    more = F.transform(a, lambda x, i: F.when(fresh(x, i), x["words"]).when(x["hi"] > F.get(a, i - 1)["hi"], x["last"]).otherwise(F.lit(0)))
    heads = F.filter(F.transform(a, lambda x, i: F.when(fresh(x, i), i)), lambda i: i.isNotNull())
    stop = lambda k: F.coalesce(F.get("heads", k + 1), F.size("a"))
    spans = F.transform("heads", lambda s, k: F.struct(
        F.get("a", s)["lo"].alias("lo"), F.get("a", stop(k) - 1)["hi"].alias("hi"),
        F.aggregate(F.slice("more", s + 1, stop(k) - s), F.lit(0), lambda n, x: n + x).alias("words")))
    sorted_ = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "words", "last"))).alias("a"))
    merged = _once(sorted_, ["key", "a"], more.alias("more"), heads.alias("heads"))
    long = F.filter(spans, lambda s: s["words"] + (AHEAD - 1) >= min_words)
    return _once(merged, ["key"], long.alias("spans")).where(F.size("spans") > 0)


def repeated_words(texts: DataFrame, order: DataFrame, min_words: int) -> DataFrame:
    """(start, first) of the places whose ``min_words`` words occur earlier, and where first; a place is row * 2^32 + word.

    ``texts`` (key, text) holds each text once; ``order`` (key, row) numbers them.

    A run that occurs twice has its whole units twice.  So a unit that occurs once rules out all runs that hold it whole
    (with a word before and ``AHEAD`` behind, as the cuts depend on these); what is left of a text are regions of repeated
    units, each with the unit before and behind, and long units.  Only there every place gets the hash of its words.
    """
    cut = stored(_grams(texts, min_words).select("key", "sizes", "marks", "seams"), "word-runs")
    # the first and the last unit are cut by the text's ends
    inner = F.slice("marks", F.lit(2), F.greatest(F.size("marks") - 2, F.lit(0)))
    marks = cut.select("key", "sizes", F.posexplode(inner).alias("lo", "m"))
    twice = cut.select(F.explode(inner).alias("m"))
    twice = stored(twice.groupBy("m").agg(F.count("*").alias("n")).where("n > 1").select("m"), "word-marks")
    bits = stored(key_bitmap(twice, "m", BITMAP_BUCKETS), "word-bits")
    size = lambda i: F.get("sizes", F.col("lo") + i)
    units = in_bitmap(marks, "m", bits, BITMAP_BUCKETS, "maybe").where("maybe").select(
        "key", "lo", (F.col("lo") + 2).alias("hi"), (size(0) + size(1) + size(2)).alias("words"), size(2).alias("last"))
    found = units.union(cut.select("key", F.inline("seams")))
    regions = stored(_regions(found, min_words).join(order, "key"), "word-regions")
    # only texts with such regions are looked at again
    keys = stored(key_bitmap(regions, "key", BITMAP_BUCKETS), "word-keys")
    asked = in_bitmap(texts, "key", keys, BITMAP_BUCKETS, "asked").where("asked").select("key", "text").join(regions, "key")
    behind = lambda s: F.slice(F.split(F.get("units", s["hi"] + 1), " "), 1, AHEAD - 1)
    pieces = F.transform("spans", lambda s: F.struct(
        F.aggregate(F.slice("sizes", F.lit(1), s["lo"]), F.lit(0), lambda n, x: n + x).alias("at"),
        F.concat(F.split(F.array_join(F.slice("units", s["lo"] + 1, s["hi"] - s["lo"] + 1), " "), " "),
                 F.coalesce(behind(s), F.array().cast("array<string>"))).alias("words")))
    rows = _once(_grams(asked, min_words), ["row"], pieces.alias("p")).select("row", F.inline("p"))
    rows = rows.select((F.shiftleft("row", 32) + F.col("at")).alias("start"), F.transform("words", lambda x: F.xxhash64(x)).alias("grams"))
    # hashes of 2^k words are made from two of half the length
    k = min_words.bit_length() - 1
    for shift in [2 ** i for i in range(k)] + [min_words - 2 ** k]:
        rows = rows.withColumn("grams", _joined(F.col("grams"), shift, lambda a, b: F.xxhash64(a, b)))
    places = _once(rows, ["start"], F.col("grams")).select("start", F.posexplode("grams").alias("i", "gram"))
    places = stored(places.select((F.col("start") + F.col("i")).alias("start"), "gram"), "word-places")
    groups = stored(places.groupBy("gram").agg(F.min("start").alias("first"), F.count("*").alias("n")).where("n > 1").select("gram", "first"), "word-groups")
    bits = stored(key_bitmap(groups, "gram", BITMAP_BUCKETS), "word-gram-bits")
    again = in_bitmap(places, "gram", bits, BITMAP_BUCKETS, "maybe").where("maybe").select("start", "gram")
    return again.join(groups, "gram").where("first < start").select("start", "first")


def _spans(later: DataFrame, min_words: int) -> DataFrame:
    """(row, spans): the words of the runs from ``later``, as (start, stop) in order, apart from each other."""
    at = later.select(F.shiftright("start", 32).alias("row"), F.col("start").bitwiseAND((1 << 32) - 1).cast("int").alias("at"))
    sorted_ = at.groupBy("row").agg(F.sort_array(F.collect_list("at")).alias("a"))
    a = F.col("a")
    starts = F.filter(a, lambda x, i: (i == 0) | (x - F.get(a, i - 1) > min_words))
    lasts = F.filter(a, lambda x, i: F.coalesce(F.get(a, i + 1) - x > min_words, F.lit(True)))
    return sorted_.select("row", F.zip_with(starts, lasts, lambda x, y: F.struct(x.alias("start"), (y + min_words).alias("stop"))).alias("spans"))


def dedup_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_lines, deleted_lines (those that lost all their words), deleted_words and text without them.

    A run of at least ``min_words`` consecutive words that occurs earlier, in an earlier document or earlier in the same
    one (documents in the order of id, null first, then of a hash of the text), is deleted, wherever in a line it starts
    or ends; its first copy stays.  Words are compared, not the white space between them.  A line that loses all its
    words goes; one that loses some keeps the others; lines without words stay.  Runs do not cross documents and may overlap.

    A null text is an empty one.  Rows that agree in id and text are one document here and get the same result.  Other
    columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), _doc_key(F.col(text_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = texts.groupBy("doc_id", "key").agg(F.count("*").alias("rows"))
    order = stored(numbered(order, ["doc_id", "key"], "word-docs"), "word-order")
    firsts = stored(order.groupBy("key").agg(F.min("row").alias("row"), F.count("*").alias("n"), F.sum("rows").alias("rows")), "word-firsts")
    # equal texts are looked at once: all but the first go as a whole
    bits = stored(key_bitmap(firsts.where("rows > 1"), "key", BITMAP_BUCKETS), "word-several-bits")
    flagged = in_bitmap(texts.select("key", "text"), "key", bits, BITMAP_BUCKETS, "maybe")
    several = stored(flagged.where("maybe").groupBy("key").agg(F.first("text").alias("text")), "word-several")
    once = flagged.where("NOT maybe").select("key", "text").union(several)
    spans = _spans(repeated_words(once, firsts.select("key", "row"), min_words), min_words)
    copies = order.join(firsts.where("n > 1").select("key", F.col("row").alias("_first")), "key").where("row != _first")
    every = F.array(F.struct(F.lit(0).alias("start"), F.lit(2 ** 31 - 1).alias("stop")))
    gone = spans.join(order, "row").select("doc_id", "key", "spans").union(copies.select("doc_id", "key", every))
    return _without_words(texts, stored(gone, "word-gone"), min_words, id_col)


def _without_words(texts: DataFrame, gone: DataFrame, min_words: int, id_col: str) -> DataFrame:
    """Only texts that may lose words are shuffled to the join; a bitmap lets the others pass."""
    named = gone.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "spans")
    bits = stored(key_bitmap(named, "_key", BITMAP_BUCKETS), "word-doc-bits")
    flagged = in_bitmap(texts, "key", bits, BITMAP_BUCKETS, "maybe")
    none = F.array().cast("array<int>")
    n_lines = F.size(_lines(F.col("text"))).cast("long").alias("n_lines")
    same = [F.col("doc_id").alias(id_col), n_lines, none.alias("deleted_lines"), F.lit(0).cast("long").alias("deleted_words"), "text"]
    some = flagged.where("maybe")
    joined = some.join(named, some["doc_id"].eqNullSafe(named["_id"]) & (some["key"] == named["_key"]), "left")
    # \0 will stand for a deleted word; texts that hold it are written with \1 before
    safe = F.replace(F.replace("text", F.lit("\x01"), F.lit("\x01a")), F.lit("\x00"), F.lit("\x01b"))
    cut = _once(joined, ["doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans")], safe.alias("safe"))
    cut = cut.select("*", F.inline(F.array(F.struct(F.regexp_extract_all("safe", F.lit(f"[{SPACES}]*{WORD}"), F.lit(0)).alias("words")))))
    size = F.size("words")
    # copies of a short text stay
    spans = F.filter(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.least(s["stop"], size).alias("stop"))), lambda s: size >= min_words)
    cut = cut.select("doc_id", "text", "safe", "words", F.inline(F.array(F.struct(spans.alias("spans")))))

    def part(s, i):
        before = F.coalesce(F.get("spans", i - 1)["stop"], F.lit(0))
        lost = F.array_join(F.slice("words", s["start"] + 1, s["stop"] - s["start"]), "")
        return F.concat(F.array_join(F.slice("words", before + 1, s["start"] - before), ""), F.regexp_replace(lost, WORD, "\x00"))

    last = F.coalesce(F.get("spans", F.size("spans") - 1)["stop"], F.lit(0))
    rest = F.slice("words", last + 1, size - last)
    tail = F.substring("safe", F.length(F.rtrim("safe", F.lit(SPACES))) + 1, F.length("safe"))
    marked = F.concat(F.array_join(F.transform("spans", part), ""), F.array_join(rest, ""), tail)
    words_gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    cut = cut.select("doc_id", "text", words_gone.alias("words_gone"), F.inline(F.array(F.struct(_lines(marked).alias("_lines")))))
    empty = lambda x: F.contains(x, F.lit("\x00")) & (F.translate(x, SPACES + "\x00", "") == "")
    lines_gone = F.filter(F.transform("_lines", lambda x, i: F.when(empty(x), i)), lambda i: i.isNotNull())

    def kept(x):
        left = F.regexp_replace(F.regexp_replace(x, f"^[{SPACES}\x00]*\x00[{SPACES}]*", ""), f"[{SPACES}]*\x00", "")
        x = F.when(F.contains(x, F.lit("\x00")), left).otherwise(x)
        return F.replace(F.replace(x, F.lit("\x01b"), F.lit("\x00")), F.lit("\x01a"), F.lit("\x01"))

    text = F.array_join(F.transform(F.filter("_lines", lambda x: ~empty(x)), kept), "\n")
    changed = cut.select(F.col("doc_id").alias(id_col), n_lines, lines_gone.alias("deleted_lines"), F.col("words_gone").alias("deleted_words"), text.alias("text"))
    return flagged.where("NOT maybe").select(*same).union(changed)
