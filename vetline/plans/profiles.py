"""Risk-oriented search profiles applied to text, as a relational division over posting lists.

A profile is an AND of OR-groups of terms. Terms match whole words without regard to case; a trailing ``*``
matches any word ending. Profiles are rows, any number of them:

1. Terms are cut into words and single signs. Each is one posting: its text, how many pieces it has, and, for an
   open ending, how much of the last piece counts. Equal groups of different profiles are one group.
2. A text is cut alike. At every place it gives the stretches of the lengths that postings have, so that a phrase
   meets its posting in an equality join with all its words in place. Only how postings are shaped (a few
   lengths, one row) goes to the driver.
3. Up to FEW profiles: distinct texts that meet a posting are numbered. Postings, groups and profiles hold bitmaps of
   the numbers: a group is the union of its terms, a profile the intersection of its groups.
4. More profiles: texts and profiles are dealt into buckets and slices of a bounded size, and each pair of a bucket and a
   slice is one task. It makes bitmaps of the bucket's rows for the slice's postings, unites and intersects them in
   memory, and gives the result's rows. Only what texts and profiles hold is shuffled, never what grows with texts times
   profiles. Texts without a hit shuffle nothing in either way.

An empty term or a lone ``*`` matches nothing; neither does a profile without groups or with a group without terms.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from vetline.operators.batches import assign_batches
from vetline.operators.coverage import id_bitmaps, merge_bitmaps
from vetline.session import materialize

PIECES = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]"
WORD = r"^[\p{L}\p{N}]"
SLOTS = 1 << 12  # of first pieces; a constant of the plan
BITMAP = 1 << 15  # bits in one of Spark's bitmaps
FEW = 256  # profiles whose bitmaps are shuffled
BUCKET_ROWS = 1 << 12  # rows of texts in a bucket, about
SLICE_PROFILES = 1 << 14  # profiles in a slice, about
CHUNK = 1 << 11  # profiles whose bitmaps are in memory at once
PLACES = (15, 26)  # least and most bits, as a power of 2, of the bitmap that tells which stretches may be postings
PROFILE_SCHEMA = "profile_id string, groups array<array<string>>, expected_risk_category string, enabled boolean"


@dataclass(frozen=True)
class Profile:
    profile_id: str
    groups: tuple[tuple[str, ...], ...]
    expected_risk_category: str
    enabled: bool = True


# The five risk profiles.
DEFAULT_PROFILES = (
    Profile(
        "P1_payments",
        (
            ("менеджер", "консультант", "специалист"),
            ("обнал*", "серые схемы", "платёжный агент", "переводы на карту"),
        ),
        "payments",
    ),
    Profile(
        "P2_crypto",
        (("оператор", "администратор", "трейдер"), ("крипто*", "p2p", "обменник", "арбитраж")),
        "crypto",
    ),
    Profile(
        "P3_gambling",
        (("оператор", "саппорт", "менеджер"), ("казино", "гемблинг", "betting", "букмекер", "ставки")),
        "gambling",
    ),
    Profile(
        "P4_grey_schemes",
        (("курьер", "водитель", "регистратор"), ("наличные", "на карту", "без договора", "номинал")),
        "grey_schemes",
    ),
    Profile(
        "P5_scam_baits",
        (("менеджер", "помощник"), ("быстрый заработок", "без опыта", "легкие деньги", "выплаты ежедневно")),
        "scam",
    ),
)


def profile_rows(spark: SparkSession, profiles: Iterable[Profile] = DEFAULT_PROFILES) -> DataFrame:
    """Profiles written in code as rows."""
    rows = [(p.profile_id, [list(group) for group in p.groups], p.expected_risk_category, p.enabled) for p in profiles]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def enabled_profiles(profiles: DataFrame) -> DataFrame:
    """Profile rows that are switched on; an unset switch counts as off."""
    return profiles.filter(F.col("enabled"))


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(PIECES), F.lit(0))


def _slot(lead: Column) -> Column:
    return F.pmod(F.xxhash64(lead), F.lit(SLOTS)).cast("int")


def _posting(pieces: Column, opened: Column, stretch: Column) -> Column:
    """What a term and a place of a text are joined on: a text, because distinct texts are found by hash."""
    return F.concat(pieces.cast("string"), F.lit(":"), F.coalesce(opened.cast("string"), F.lit("")), F.lit(":"), stretch)


def postings(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(group_key, pieces, open, sign, slot, posting)`` a row per term, and ``(profile_id, category, groups)`` a row per profile.

    pieces: how many the term has; open: how many characters of the last one count, NULL for all; sign: whether it
    starts with a sign; slot: that of its first piece.
    """
    # the key of a group is that of its terms, so groups that profiles share are looked for once
    terms = F.array_sort(F.array_distinct(F.transform("terms", lambda term: F.lower(term))))
    flat = (
        enabled_profiles(profiles)
        .select("profile_id", F.col("expected_risk_category").alias("category"), F.posexplode("groups").alias("group_no", "terms"))
        .withColumn("terms", terms)
        .withColumn("group_key", F.xxhash64("terms"))
    )
    term = flat.select("group_key", "terms").dropDuplicates(["group_key"]).select("group_key", F.explode("terms").alias("term"))
    opened = term.withColumn("ending", F.col("term").endswith("*")).withColumn("term", F.regexp_replace("term", r"\*$", ""))
    cut = opened.filter("term <> ''").withColumn("parts", _pieces(F.col("term")))
    last = F.element_at("parts", -1)
    size, length = F.size("parts"), F.length(last)
    whole = F.struct(size.alias("pieces"), F.lit(None).cast("int").alias("open"))
    forms = (
        F.when(~F.col("ending"), F.array(whole))
        .when(last.rlike(WORD), F.array(F.struct(size.alias("pieces"), length.alias("open"))))
        # a sign may be followed by a word or by none
        .otherwise(F.array(whole, F.struct((size + 1).alias("pieces"), F.lit(0).alias("open"))))
    )
    formed = cut.select("group_key", "term", F.explode(forms).alias("form")).select("group_key", "term", "form.*")
    lead = F.when(F.col("pieces") == 1, F.col("term")).otherwise(F.regexp_extract(F.lower("term"), PIECES, 0))
    posted = formed.select("group_key", "pieces", "open", (~F.col("term").rlike(WORD)).alias("sign"), _slot(lead).alias("slot"), _posting(F.col("pieces"), F.col("open"), F.col("term")).alias("posting"))
    wanted = flat.groupBy("profile_id", "category").agg(F.collect_set("group_key").alias("groups"))
    return posted, wanted


def _stretches(shapes: list[tuple[int, int | None]], signs: bool, slots: list[int]) -> Column:
    """Distinct postings of a text in pieces (`_parts`; `_distinct` has each once).

    slots: those that first pieces of terms have. Most places of a text have another one and stop there, unless the
    terms have most of them.
    """
    parts = F.col("_parts")
    taken = bytearray(SLOTS)
    for slot in slots:
        taken[slot] = 1
    table = F.lit(bytes(taken))

    def asked(lead: Column) -> Column:
        return F.substring(table, _slot(lead) + 1, F.lit(1)) == F.lit(b"\x01") if len(slots) < SLOTS // 2 else F.lit(True)

    def word(at: Column) -> Column:
        return F.coalesce(F.get(parts, at).rlike(WORD), F.lit(False))

    def form(pieces: int, opened: int | None, stretch: Column) -> Column:
        return _posting(F.lit(pieces), F.lit(opened).cast("int"), stretch)

    def of_shape(pieces: int, opened: int | None) -> Column:
        if pieces == 1 and not (signs and opened is None):
            start = lambda part: part if opened is None else F.left(part, F.lit(opened))
            words = F.filter("_distinct", lambda part: asked(start(part)) & part.rlike(WORD) & (F.length(part) >= (opened or 0)))
            return F.transform(words, lambda part: form(1, opened, start(part)))

        def at_place(at: Column) -> Column:
            last = at + (pieces - 1)
            # no word goes on at either border
            free = (word(at) | ~word(at - 1)) if signs else word(at)
            if opened is None:
                free = free & (word(last) | ~word(last + 1))
                held = [F.get(parts, at + i) for i in range(pieces)]
            else:
                free = free & word(last) & (F.length(F.get(parts, last)) >= opened)
                held = [*(F.get(parts, at + i) for i in range(pieces - 1)), F.left(F.get(parts, last), F.lit(opened))]
            # piece by piece: to slice an array copies all of it
            return F.when(free, form(pieces, opened, F.concat(*held)))

        places = F.when(F.size(parts) >= pieces, F.sequence(F.lit(0), F.size(parts) - pieces)).otherwise(F.array().cast("array<int>"))
        return F.array_compact(F.transform(F.filter(places, lambda at: asked(F.get(parts, at))), at_place))

    return F.array_distinct(F.concat(*[of_shape(pieces, opened) for pieces, opened in shapes]))


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(profile_id, category, number)`` from ``(profile_id, category, bucket, ids)``, some 64 K rows at a time."""

    def packed(held: list[tuple]) -> pa.RecordBatch:
        times = [len(numbers) for _, _, numbers in held]
        names = [pa.array([row[i] for row in held], pa.string()).take(pa.array(np.repeat(np.arange(len(held)), times))) for i in range(2)]
        return pa.RecordBatch.from_arrays([*names, pa.array(np.concatenate([numbers for _, _, numbers in held]))], ["search_profile", "_category", "_number"])

    held, rows = [], 0
    for batch in batches:
        for profile, category, bucket, ids in zip(*(batch.column(i) for i in range(4)), strict=True):
            bits = np.unpackbits(np.frombuffer(ids.as_buffer(), np.uint8), bitorder="little")
            numbers = np.flatnonzero(bits).astype(np.int64) + ((bucket.as_py() - 1) * BITMAP + 1)
            held.append((profile.as_py(), category.as_py(), numbers))
            rows += len(numbers)
            if rows >= 1 << 16:
                yield packed(held)
                held, rows = [], 0
    if held:
        yield packed(held)


def _list(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """Lists of the values that stop before `ends`."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(values))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of the lists, and how many each has."""
    return lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _turned(said: pa.Array, more: pa.Array) -> pa.Array:
    """Per bucket, from the postings of each row: its distinct postings by key and the rows that meet each."""
    parts = []
    for one, two in zip(said, more, strict=True):
        key, times = _flat(one.values)
        check, _ = _flat(two.values)
        row = np.repeat(np.arange(len(times), dtype=np.int32), times)
        order = np.lexsort((row, check, key))
        key, check, row = key[order], check[order], row[order]
        first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (check[1:] != check[:-1]))[: len(key)]))
        parts.append((key[first], check[first], np.diff(np.append(first, len(key))).astype(np.int32), row, len(times)))
    columns = []
    for i, kind in enumerate((np.int64, np.int64, np.int32, np.int32)):
        values = [part[i] for part in parts]
        columns.append(_list(np.concatenate([*values, np.empty(0, kind)]).astype(kind), np.cumsum([len(v) for v in values])))
    columns.append(pa.array([part[4] for part in parts], pa.int32()))
    return pa.StructArray.from_arrays(columns, ["key", "check", "times", "row", "rows"])


def _of_tile(key, check, times, row, rows: int, asked_key, asked_check, terms, groups) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a bucket that meet each profile of a slice: all rows, and how many each profile has.

    key, check, times, row: the bucket's postings as `_turned` gives them. asked_key, asked_check: the postings of all
    groups of all profiles; terms: how many each group has; groups: how many each profile has.
    """
    width = -(-rows // 64) * 8
    place = np.searchsorted(key, asked_key)
    met = np.zeros(len(asked_key), bool)
    left = np.arange(len(asked_key))
    while len(left):
        left = left[place[left] < len(key)]
        left = left[key[place[left]] == asked_key[left]]
        same = check[place[left]] == asked_check[left]
        met[left[same]] = True
        # equal keys with other checks lie side by side
        left = left[~same]
        place[left] += 1
    used, line = np.unique(place[met], return_inverse=True)
    # a bitmap per posting that the slice asks for; the last one is of those that no row meets
    lines = np.full(len(asked_key), len(used))
    lines[met] = line
    bits = np.zeros((len(used) + 1, width), np.uint8)
    starts = np.cumsum(times, dtype=np.int64) - times
    size = times[used].astype(np.int64)
    at = row[np.repeat(starts[used] - (np.cumsum(size) - size), size) + np.arange(size.sum())].astype(np.int64)
    # each row once per posting, so that sums are unions
    np.add.at(bits.reshape(-1), np.repeat(np.arange(len(used)) * width, size) + (at >> 3), np.left_shift(1, at & 7).astype(np.uint8))
    words = bits.view(np.uint64)
    first_group = np.cumsum(groups) - groups
    first_term = np.cumsum(terms) - terms
    found, counts = [], np.zeros(len(groups), np.int64)
    for low in range(0, len(groups), CHUNK):
        high = min(low + CHUNK, len(groups))
        of_group = slice(first_group[low], first_group[high - 1] + groups[high - 1])
        begin, end = first_term[of_group.start], first_term[of_group.stop - 1] + terms[of_group.stop - 1]
        united = np.bitwise_or.reduceat(words[lines[begin:end]], first_term[of_group] - begin, axis=0)
        whole = np.bitwise_and.reduceat(united, first_group[low:high] - first_group[low], axis=0).view(np.uint8).reshape(-1)
        filled = np.flatnonzero(whole)
        place, bit = np.nonzero(np.unpackbits(whole[filled], bitorder="little").reshape(-1, 8))
        byte = filled[place]
        found.append((byte % width * 8 + bit).astype(np.int32))
        counts[low:high] = np.bincount(byte // width, minlength=high - low)
    return np.concatenate(found), counts


def _tile(posts: pa.Array, asked_key: pa.Array, asked_check: pa.Array, terms: pa.Array) -> pa.Array:
    """Per pair of a bucket and a slice: for each profile of the slice the rows of the bucket that meet it."""
    found, counts, profiles = [], [], []
    for post, keys, checks, sizes in zip(posts, asked_key, asked_check, terms, strict=True):
        held = [post[name].values.to_numpy(zero_copy_only=False) for name in ("key", "check", "times", "row")]
        size, groups = _flat(sizes.values)
        rows, each = _of_tile(*held, post["rows"].as_py(), _flat(keys.values)[0], _flat(checks.values)[0], size.astype(np.int64), groups)
        found.append(rows)
        counts.append(each)
        profiles.append(len(each))
    inner = _list(np.concatenate([*found, np.empty(0, np.int32)]), np.cumsum(np.concatenate([*counts, np.empty(0, np.int64)])))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(profiles))).astype(np.int32)), inner)


def _key(posting: Column) -> Column:
    return F.xxhash64(posting)


def _check(posting: Column) -> Column:
    """With the key 128 bits that stand for a posting."""
    return F.xxhash64(F.lit(1), posting)


def _may_be_posting(spark: SparkSession, posted: DataFrame, postings: int):
    """Which stretches of a text, by their keys, may be postings: all that are, and few others.

    The bitmap that tells has 2^26 bits (8 MB) at most, however many postings there are.
    """
    bits = min(max(int(postings * 32).bit_length(), PLACES[0]), PLACES[1])
    number = F.pmod(_key(F.col("posting")), F.lit(1 << bits)) + 1
    table = np.zeros(1 << (bits - 3), np.uint8)
    for part in id_bitmaps(posted.select(number.alias("number")), "number").collect():
        at = (part["bucket"] - 1) * BITMAP // 8
        table[at : at + BITMAP // 8] = np.frombuffer(part["ids"], np.uint8)
    shared = spark.sparkContext.broadcast(table)

    @F.arrow_udf("array<int>")
    def may_be(said: pa.Array) -> pa.Array:
        keys, times = _flat(said)
        place = keys & ((1 << bits) - 1)
        held = np.flatnonzero(shared.value[place >> 3] >> (place & 7) & 1)
        ends = np.cumsum(times)
        last = np.searchsorted(held, ends)
        # places within their own text
        return _list((held - np.repeat(ends - times, np.diff(np.append(0, last)))).astype(np.int32), last)

    # not deterministic, or the filter on its result would run it once more
    return may_be.asNondeterministic()


def _by_tiles(df: DataFrame, cut: DataFrame, stretches: Column, posted: DataFrame, wanted: DataFrame, postings: int, profiles: int) -> DataFrame:
    """`cut`: the rows of `df` with their texts in pieces."""
    held = {f"_c{i}": F.col(f"`{f.name}`") for i, f in enumerate(df.schema)}
    may_be = _may_be_posting(df.sparkSession, posted, postings)
    buckets = max(1, -(-df.count() // BUCKET_ROWS))
    slices = max(1, -(-profiles // SLICE_PROFILES))
    # all plain columns decide, so that copies of a text are dealt out; rows equal in all of them stay together
    plain = [f"`{f.name}`" for f in df.schema if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    said = cut.select(
        # a struct keeps nulls in a list
        *[F.struct(column.alias("value")).alias(name) for name, column in held.items()],
        F.pmod(F.xxhash64(*plain), F.lit(buckets)).cast("int").alias("_bucket"),
        # exploded, because the optimizer would write the pieces into a projection and cut the text at every place anew
        F.explode(F.array(stretches)).alias("_stretches"),
    )
    # numbers only, because Spark holds the rows that wait for Python, beyond its memory on disk
    keyed = said.select(*held, "_bucket", F.transform("_stretches", _key).alias("_keys"), F.transform("_stretches", _check).alias("_checks"))
    kept = keyed.withColumn("_kept", may_be("_keys")).filter(F.size("_kept") > 0)
    key = F.transform("_kept", lambda at: F.get("_keys", at)).alias("_key")
    check = F.transform("_kept", lambda at: F.get("_checks", at)).alias("_check")
    # lists of one aggregate are in the same order
    lists = [F.collect_list(name).alias(name) for name in (*held, "_key", "_check")]
    bucket = kept.select(*held, "_bucket", key, check).repartition(buckets, "_bucket").groupBy("_bucket").agg(*lists)
    turned = F.arrow_udf(_turned, "key array<bigint>, check array<bigint>, times array<int>, row array<int>, rows int")
    # dealt out by number, so that a task of the product below has one bucket and one slice
    bucket = bucket.select("_bucket", *held, turned("_key", "_check").alias("_posts")).repartitionById(buckets, F.col("_bucket"))

    group = posted.select("group_key", "posting").distinct().groupBy("group_key").agg(F.collect_list(_key(F.col("posting"))).alias("key"), F.collect_list(_check(F.col("posting"))).alias("check"))
    asked = wanted.select("profile_id", "category", F.size("groups").alias("needed"), F.explode("groups").alias("group_key")).join(group, "group_key")
    profile = asked.groupBy("profile_id", "category", "needed").agg(F.collect_list(F.struct("key", "check")).alias("held")).filter(F.size("held") == F.col("needed"))
    flat = profile.select(
        F.pmod(F.xxhash64("profile_id", "category"), F.lit(slices)).cast("int").alias("_slice"),
        F.struct("profile_id", "category").alias("_profile"),
        F.flatten("held.key").alias("_asked_key"),
        F.flatten("held.check").alias("_asked_check"),
        F.transform("held", lambda terms: F.size(terms["key"])).alias("_terms"),
    )
    slice_ = flat.groupBy("_slice").agg(*[F.collect_list(name).alias(name) for name in flat.columns[1:]]).repartitionById(slices, F.col("_slice"))

    # not deterministic, or a filter that the optimizer finds for the explode would run it twice
    tile = F.arrow_udf(_tile, "array<array<int>>").asNondeterministic()
    met = bucket.hint("shuffle_replicate_nl").crossJoin(slice_).withColumn("_met", tile("_posts", "_asked_key", "_asked_check", "_terms"))
    each = met.select(*held, "_profile", F.posexplode("_met").alias("_at", "_rows")).select(*held, F.get("_profile", "_at").alias("_profile"), F.explode("_rows").alias("_row"))
    out = [F.get(name, F.col("_row"))["value"].alias(column) for name, column in zip(held, df.columns, strict=True)]
    return each.select(*out, F.col("_profile.profile_id").alias("search_profile"), F.col("_profile.category").alias("expected_risk_category"))


def tag_profiles(df: DataFrame, text: str, profiles: DataFrame | Iterable[Profile] = DEFAULT_PROFILES) -> DataFrame:
    """Each row once per profile it matches, with the profile id and the expected category.

    profiles: rows ``(profile_id, groups, expected_risk_category, enabled)``, or profiles written in code.
    """
    if not isinstance(profiles, DataFrame):
        profiles = profile_rows(df.sparkSession, profiles)
    profiles = materialize(profiles.select("profile_id", "groups", F.col("expected_risk_category").cast("string").alias("expected_risk_category"), "enabled"), "profiles")
    posted, wanted = postings(profiles)
    posted = materialize(posted, "postings")
    shape = posted.agg(
        F.sort_array(F.collect_set(F.struct("pieces", F.coalesce("open", F.lit(-1)).alias("open")))).alias("shapes"),
        F.max("sign").alias("signs"),
        F.collect_set("slot").alias("slots"),
        F.count("*").alias("postings"),
    ).first()
    # one row: the few distinct lengths that terms have, and SLOTS numbers at most
    shapes = [(s["pieces"], None if s["open"] < 0 else s["open"]) for s in shape["shapes"]]
    marked = df.withColumn("_text_key", F.unhex(F.md5(text)))
    if not shapes:
        return marked.filter("false").withColumns({"search_profile": F.lit(None).cast("string"), "expected_risk_category": F.lit(None).cast("string")}).drop("_text_key")

    def cut(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_parts", _pieces(F.col(text))).withColumn("_distinct", F.array_distinct("_parts"))

    stretches = _stretches(shapes, bool(shape["signs"]), shape["slots"])
    many = enabled_profiles(profiles).count()
    if many > FEW:
        given = df.drop("search_profile", "expected_risk_category")
        return _by_tiles(given, cut(given.filter(F.col(text).isNotNull())), stretches, posted, wanted, shape["postings"], many)
    said = cut(marked.filter(F.col(text).isNotNull()).select("_text_key", text)).select("_text_key", F.explode(stretches).alias("posting"))
    # texts are told apart by a 128-bit hash: copies of a text are looked at once from here on
    met = materialize(said.join(posted.select("posting").distinct(), "posting", "left_semi").distinct(), "postings_met")
    numbered = assign_batches(met.select("_text_key").distinct(), 1, [F.col("_text_key")], name="_text_no").select("_text_key", (F.col("_text_no").cast("long") + 1).alias("_number"))
    # a posting, a group and a profile are each met by a set of text numbers, in bitmaps: a group unites its terms', a
    # profile intersects its groups'. Rows per text and group would be as many as texts times groups
    by_posting = id_bitmaps(met.join(numbered, "_text_key"), "_number", ["posting"])
    by_group = merge_bitmaps(posted.select("group_key", "posting").distinct().join(by_posting, "posting"), ["group_key"])
    asked = wanted.select("profile_id", "category", F.size("groups").alias("needed"), F.explode("groups").alias("group_key"))
    shared = asked.join(by_group, "group_key").groupBy("profile_id", "category", "needed", "bucket").agg(F.count("*").alias("met"), F.bitmap_and_agg("ids").alias("ids"))
    whole = shared.filter((F.col("met") == F.col("needed")) & (F.bitmap_count("ids") > 0)).select("profile_id", "category", "bucket", "ids")
    hits = whole.mapInArrow(_numbers, "search_profile string, _category string, _number long")
    out = marked.drop("search_profile", "expected_risk_category").join(numbered, "_text_key").join(hits, "_number")
    return out.withColumnRenamed("_category", "expected_risk_category").drop("_text_key", "_number")
