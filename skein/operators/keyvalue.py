"""Key/value, set and ranked-set operations as DataFrame operations over keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window


def multi_get(requests: DataFrame, store: DataFrame, key: str = "key") -> DataFrame:
    """A row for every request, in place; found says whether the store has the key."""
    there = store.withColumn("found", F.lit(True))
    return requests.join(there, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def last_write(writes: DataFrame, order: str, key: str = "key") -> DataFrame:
    """Of the writes of a key, the one with the largest order; a combinable aggregate, so hot keys shrink before the shuffle."""
    others = [c for c in writes.columns if c != key]
    return writes.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_")).select(key, *(F.col(f"_.{c}") for c in others))


def upsert(store: DataFrame, writes: DataFrame, order: str, key: str = "key") -> DataFrame:
    """store after the writes: the last write of a key replaces its row."""
    return store.join(writes, key, "left_anti").unionByName(last_write(writes, order, key).drop(order))


def first_write(writes: DataFrame, order: str, key: str = "key") -> DataFrame:
    """Of the writes of a key, the one with the smallest order."""
    others = [c for c in writes.columns if c != key]
    return writes.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("_")).select(key, *(F.col(f"_.{c}") for c in others))


def set_if_absent(store: DataFrame, writes: DataFrame, order: str, key: str = "key") -> DataFrame:
    """store, and of the keys that it lacks the first write each: the later ones find a key."""
    return store.unionByName(first_write(writes.join(store, key, "left_anti"), order, key).drop(order))


def set_if_present(store: DataFrame, writes: DataFrame, order: str, key: str = "key") -> DataFrame:
    """store, with the last write of each of its own keys."""
    return store.join(writes, key, "left_anti").unionByName(last_write(writes.join(store, key, "left_semi"), order, key).drop(order))


def exists_count(asked: DataFrame, store: DataFrame, request: str, key: str = "key") -> DataFrame:
    """request and n: how many of its keys are there; a key asked for twice counts twice."""
    there = store.select(key, F.lit(1).alias("there"))
    return asked.join(there, key, "left").groupBy(request).agg(F.count("there").alias("n"))


def delete_keys(store: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    return store.join(keys, key, "left_anti")


def ttl_state(asked: DataFrame, store: DataFrame, now: Column, key: str = "key", expires: str = "expires_at") -> DataFrame:
    """asked with ttl: what is left until a key expires, -1 if it never does, -2 if it isn't there (any more)."""
    known = store.select(key, F.col(expires).alias("_expires"), F.lit(True).alias("_there"))
    left = F.col("_expires") - now
    ttl = F.when(F.col("_there").isNull() | (left <= 0), -2).when(F.col("_expires").isNull(), -1).otherwise(left)
    return asked.join(known, key, "left").withColumn("ttl", ttl).drop("_expires", "_there")


def expire(store: DataFrame, keys: DataFrame, at: Column | None, key: str = "key", expires: str = "expires_at") -> DataFrame:
    """store with a new expiry for the keys; without one they are persisted."""
    hit = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    kind = store.schema[expires].dataType
    return store.join(hit, key, "left").withColumn(expires, F.when(F.col("_hit"), (F.lit(None) if at is None else at).cast(kind)).otherwise(F.col(expires))).drop("_hit")


def rename_keys(store: DataFrame, names: DataFrame, key: str = "key") -> DataFrame:
    """store with the keys of names (key, new) renamed; a row that had the new name is replaced."""
    moved = store.join(names, key).drop(key).withColumnRenamed("new", key)
    return store.join(names, key, "left_anti").join(moved, key, "left_anti").unionByName(moved)


def hash_set(hashes: DataFrame, writes: DataFrame, order: str) -> DataFrame:
    """(key, field, value) after the writes, the last of each field."""
    last = writes.groupBy("key", "field").agg(F.max_by("value", order).alias("value"))
    return hashes.join(last, ["key", "field"], "left_anti").unionByName(last)


def hash_get_all(hashes: DataFrame) -> DataFrame:
    """key and its fields as a map, and their number."""
    own = hashes.groupBy("key").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value")))).alias("fields"))
    return own.withColumn("n", F.size("fields"))


def hash_mget(hashes: DataFrame, fields: list[str]) -> DataFrame:
    """key and the values of the fields, in their order, null in the place of one that is missing; in one pass."""
    return hashes.groupBy("key").agg(F.array(*(F.max(F.when(F.col("field") == f, F.col("value"))) for f in fields)).alias("values"))


def hash_increment(hashes: DataFrame, deltas: DataFrame) -> DataFrame:
    """(key, field, value: long) with all deltas (key, field, delta) added; a missing field counts as 0."""
    both = hashes.select("key", "field", F.col("value").alias("d")).unionByName(deltas.select("key", "field", F.col("delta").alias("d")))
    return both.groupBy("key", "field").agg(F.sum("d").alias("value"))


def rank_range(members: DataFrame, key: str, score: str, member: str, first: int, last: int) -> DataFrame:
    """Members of rank first to last (from 0, both included, not negative), with rank; Spark cuts each task's members down before the shuffle."""
    return ranked(members, key, score, member).where((F.col("rank") >= first) & (F.col("rank") <= last))


def set_members(sets: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (key, member) with is_member, in place."""
    there = sets.select("key", "member").distinct().withColumn("is_member", F.lit(True))
    return asked.join(there, ["key", "member"], "left").withColumn("is_member", F.coalesce("is_member", F.lit(False)))


def bit_counts(bits: DataFrame, key: str, bit: str) -> DataFrame:
    """key and n: bits that are set, each once. Words of 64 bits are built before the shuffle; one is a number, so tasks hold no bitmaps and can spill."""
    at = F.col(bit).cast("long")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    words = bits.groupBy(key, F.shiftright(at, 6).alias("_word")).agg(F.bit_or(mask).alias("_bits"))
    return words.groupBy(key).agg(F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("long").alias("n"))


def distinct_estimates(members: DataFrame, key: str, member: str, log2_buckets: int = 14) -> DataFrame:
    """key, n (estimated number of different members) and sketch, which can be merged with others of the key."""
    return members.groupBy(key).agg(F.hll_sketch_agg(member, log2_buckets).alias("sketch")).withColumn("n", F.hll_sketch_estimate("sketch"))


def merged_estimates(sketches: DataFrame, key: str) -> DataFrame:
    return sketches.groupBy(key).agg(F.hll_union_agg("sketch").alias("sketch")).withColumn("n", F.hll_sketch_estimate("sketch"))


def of_kind(value: Column, kind: Column, wanted: str) -> Column:
    """value, if the key holds the wanted kind; raises otherwise. A missing key (null kind) is null."""
    return F.when(kind.isNull() | (kind == wanted), value).otherwise(F.raise_error(F.concat(F.lit(f"not a {wanted}: "), kind)).cast("string"))


def alive(store: DataFrame, now: Column, expires: str = "expires_at") -> DataFrame:
    return store.where(F.col(expires).isNull() | (F.col(expires) > now))


def ranked(members: DataFrame, key: str, score: str, member: str) -> DataFrame:
    """members with rank from 0 by score, then member. One key's members are sorted in one task; see first_ranked for few of them."""
    return members.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(score, member)).cast("long") - 1)


def pop_min(members: DataFrame, key: str, score: str, member: str) -> DataFrame:
    """Each key's member of the smallest score: a combinable aggregate."""
    return members.groupBy(key).agg(F.min(F.struct(score, member)).alias("_")).select(key, F.col(f"_.{member}").alias(member), F.col(f"_.{score}").alias(score))


def range_of(array: Column, first: Column, last: Column) -> Column:
    """Elements first to last, both included, counted from 0; negative ones count from the end."""
    n = F.size(array)
    a = F.greatest(F.when(first < 0, n + first).otherwise(first), F.lit(0))
    b = F.least(F.when(last < 0, n + last).otherwise(last), n - 1)
    return F.when(a <= b, F.slice(array, a + 1, b - a + 1)).otherwise(F.slice(array, 1, 0))


def substring_of(text: Column, first: int, last: int) -> Column:
    """Characters first to last, both included, counted from 0; negative ones count from the end."""
    n = F.length(text)
    a = F.greatest(n + first, F.lit(0)) if first < 0 else F.lit(first)
    b = F.least((n + last) if last < 0 else F.lit(last), n - 1)
    return F.when(a <= b, F.substr(text, a + 1, b - a + 1)).when(text.isNotNull(), F.lit(""))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_km: float = 6371.0) -> Column:
    """Great-circle distance (haversine)."""
    half = lambda x, y: F.pow(F.sin(F.radians(y - x) / 2), 2)
    return 2 * radius_km * F.asin(F.sqrt(half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)))


def within_km(places: DataFrame, lat: float, lon: float, km: float, latitude: str = "lat", longitude: str = "lon") -> DataFrame:
    """places with km, their distance from a point, as far as km; a box of latitudes is cut out first."""
    span = km / 6371.0 * 57.29577951308232 + 1e-9
    near = places.where(F.col(latitude).between(lat - span, lat + span))
    return near.withColumn("km", distance_km(F.lit(lat), F.lit(lon), F.col(latitude), F.col(longitude))).where(F.col("km") <= km)
