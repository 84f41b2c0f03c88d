"""Deterministic patient identity resolution.

Records are matched in arrival order by four keys, tried in turn; a match adds no keys, only a new person's record does.
The outcome depends on the order, so it isn't a closure: which records begin a person is decided in rounds, all of them
aggregations and joins by key or record, as many as the longest chain of records that wait for one another. A key that very
many records share (a default record number) is spread over tasks by salts.

Persons of earlier runs come first, as seeds. What a run may know is a matter of the order of runs, not of what tables
hold: seeds are the persons and links of runs before it, also if it is replayed when later runs are there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions.columns import normal_name, stable_id, strip

from .shared import checkpoint, numbered

# The passes in the order they are tried, with their confidence.
PASSES = (("MRN_NPI", 1.0), ("IDENTIFIER_SYSTEM", 1.0), ("SSN4_DOB_NAME", 1.0), ("DOB_NAME_ZIP", 0.95))
NEW = "NEW_RECORD"
#: Records of one key that a task takes.
HOT = 1_000_000


def _key(*parts: Column) -> Column:
    """The parts joined, or null if one is null or empty."""
    filled = [F.nullif(p.cast("string"), F.lit("")) for p in parts]
    return F.when(sum((p.isNull().cast("int") for p in filled), F.lit(0)) == 0, F.concat_ws("\x1f", *filled))


def match_keys(records: DataFrame) -> DataFrame:
    """records with the arrays' worth of keys k1..k4, each tagged with its pass."""
    c = lambda name: F.col(name) if name in records.columns else F.lit(None).cast("string")
    mrn, family, given = strip(c("source_mrn")), normal_name(c("family_name")), normal_name(c("given_name"))
    keys = [
        _key(mrn, strip(c("source_facility_npi"))), _key(strip(c("source_identifier_system")), mrn),
        _key(strip(c("ssn_last4")), c("birth_date"), family), _key(c("birth_date"), family, given, strip(c("postal_code"))),
    ]
    return records.withColumns({f"k{i}": F.concat(F.lit(f"{i}:"), k) for i, k in enumerate(keys, 1)})


def _edges(work: DataFrame) -> DataFrame:
    """One row for each key of a record: record_id, pass, key."""
    return work.select("record_id", F.posexplode("keys").alias("pass", "key")).filter("key is not null")


def _salts(n: Column) -> Column:
    """Over how many tasks the records of a key with n records are spread."""
    return F.floor(n / HOT).cast("int") + 1


def _owned(open_edges: DataFrame, owners: DataFrame) -> DataFrame:
    """Edges with the owner of their key; an owner is sent to every salt of its key."""
    each = owners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return open_edges.join(each, ["key", "salt"])


def _newcomers(live: DataFrame) -> tuple[list[DataFrame], int]:
    """Which of the records begin a person: frames (key, owner) of their keys, and how many rounds it took.

    In a round, a record that comes first in all its keys is new, and records that share a key with it are not; the rest
    goes on. So a record is decided once all earlier records with a common key are, as in a run one by one.
    """
    found: list[DataFrame] = []
    while not live.isEmpty():
        firsts = live.groupBy("key", "salts").agg(F.min("record_id").alias("owner"))
        held = live.groupBy("record_id").agg(F.count("*").alias("held"))
        led = firsts.groupBy("owner").agg(F.count("*").alias("led"))
        winners = led.join(held, F.col("owner") == F.col("record_id")).filter("led = held").select("owner")
        taken = checkpoint(firsts.join(winners, "owner").select("key", "owner", "salts"))
        found.append(taken)
        # whoever holds a taken key is decided, the winner itself too
        gone = _owned(live.select("record_id", "key", "salt"), taken).select("record_id").distinct()
        live = checkpoint(live.join(gone, "record_id", "left_anti"))
    return found, len(found)


def resolve(records: DataFrame, order: str = "arrival_seq", seeds: DataFrame | None = None) -> DataFrame:
    """records with umpi, match_method, match_confidence, is_new_record, matched_on.

    records: order (a distinct number of arrival), whatever of the matching fields there is, and record_key, which tells
    the record from those of any other run (the number of arrival if there is none): a new person's id follows from it.
    seeds: known persons, with the same fields, umpi and a distinct non-negative seq; their keys come first (the latest of
    equal ones counts).
    """
    df = match_keys(records).withColumn("record_id", F.col(order).cast("long"))
    keys = ["k1", "k2", "k3", "k4"]
    name = F.col("record_key") if "record_key" in records.columns else F.col("record_id")
    work = checkpoint(df.select("record_id", stable_id(F.lit("umpi"), name).alias("own"), F.array(*keys).alias("keys")))
    stats = _edges(work).groupBy("key").agg(F.count("*").alias("n"))
    if seeds is None:
        stats = stats.filter("n > 1").withColumns({"seed": F.lit(None).cast("long"), "person": F.lit(None).cast("string")})
    else:
        known = match_keys(seeds).select((F.col("seq").cast("long") - F.lit(1 << 62)).alias("record_id"), "umpi", F.array(*keys).alias("keys"))
        of_key = known.select("record_id", "umpi", F.explode("keys").alias("key")).filter("key is not null").groupBy("key").agg(F.max("record_id").alias("seed"), F.max_by("umpi", "record_id").alias("person"))
        stats = stats.join(of_key, "key", "left").filter("n > 1 or seed is not null")
    # keys that others know, too; the few with very many records (at most one in HOT) are spread by salts
    stats = checkpoint(stats.withColumn("salts", _salts(F.col("n"))))
    hot = stats.filter("salts > 1").select("key", F.col("salts").alias("hot"))
    salted = _edges(work).join(F.broadcast(hot), "key", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("record_id"), F.col("hot")).cast("int"), F.lit(0)))
    shared = checkpoint(_owned(salted.select("record_id", "pass", "key", "salt"), stats.select("key", "seed", "salts", F.col("salts").alias("of_key"))).withColumnRenamed("of_key", "salts"))
    stored = shared.filter("seed is not null").select("record_id").distinct()
    live = checkpoint(shared.join(stored, "record_id", "left_anti").select("record_id", "key", "salt", "salts"))
    found, _ = _newcomers(live)
    owners = stats.filter("seed is not null").select("key", F.col("seed").alias("owner"), "salts", "person")
    for taken in found:
        owners = owners.unionByName(taken.join(work.select(F.col("record_id").alias("owner"), F.col("own").alias("person")), "owner").select("key", "owner", "salts", "person"))
    # the first pass of which an earlier record owns the key
    hits = _owned(shared.select("record_id", "pass", "key", "salt"), owners).filter("owner < record_id")
    hits = hits.groupBy("record_id").agg(F.min(F.struct("pass", "person")).alias("hit"))
    result = work.join(hits, "record_id", "left").select("record_id", F.coalesce("hit.person", "own").alias("person"), F.coalesce("hit.pass", F.lit(-1)).alias("pass"), F.col("hit").isNull().alias("is_new"))
    i = F.col("pass")
    method = F.when(i < 0, NEW)
    confidence, fields = F.when(i < 0, 0.0), F.when(i < 0, F.array().cast("array<string>"))
    on = (("source_mrn", "source_facility_npi"), ("source_identifier_system", "source_mrn"), ("ssn_last4", "birth_date", "family_name"), ("birth_date", "family_name", "given_name", "postal_code"))
    for n, ((name, sure), columns) in enumerate(zip(PASSES, on, strict=True)):
        method, confidence, fields = method.when(i == n, name), confidence.when(i == n, sure), fields.when(i == n, F.array(*map(F.lit, columns)))
    result = result.select("record_id", F.col("person").alias("umpi"), method.alias("match_method"), confidence.alias("match_confidence"), F.col("is_new").alias("is_new_record"), fields.alias("matched_on"))
    return df.drop(*keys).join(result, "record_id").drop("record_id")


def crosswalk(resolved: DataFrame) -> DataFrame:
    """One row for each source record."""
    wanted = ["umpi", "tenant_id", "source_system", "source_id", "source_mrn", "source_facility_npi", "match_method", "match_confidence"]
    return resolved.select(stable_id("umpi", "source_id").alias("crosswalk_id"), *(c for c in wanted if c in resolved.columns))


def patient_index(resolved: DataFrame) -> DataFrame:
    """One row for each new person, as of its first record; person_index counts the records that were linked since."""
    wanted = ["umpi", "tenant_id", "family_name", "given_name", "birth_date", "gender", "postal_code"]
    return resolved.filter("is_new_record").select(*(c for c in wanted if c in resolved.columns), F.lit(1).alias("linked_record_count"))


def seeds_from(index: DataFrame, links: DataFrame) -> DataFrame:
    """Stored patients and crosswalk rows as seeds: crosswalk rows give MRN keys (pass 1), the patients name keys (pass 4).

    links: umpi, source_mrn, source_facility_npi; index: umpi, names, birth_date, postal_code; either with their place.
    The rows still have to be numbered, in the order of their places.
    """
    no = F.lit(None).cast("string")
    of_links = links.select(F.concat(F.lit("2/"), "place").alias("place"), "umpi", "source_mrn", "source_facility_npi", no.alias("family_name"), no.alias("given_name"), no.cast("date").alias("birth_date"), no.alias("postal_code"))
    of_index = index.select(F.concat(F.lit("1/"), "place").alias("place"), "umpi", no.alias("source_mrn"), no.alias("source_facility_npi"), "family_name", "given_name", "birth_date", "postal_code")
    return of_index.unionByName(of_links)


def as_of(rows: DataFrame, runs: DataFrame, run_seq: int, run_col: str = "pipeline_run_id") -> DataFrame:
    """Those of rows that are of runs before run_seq, with their valid_from; runs: run_id, run_seq (one row a run)."""
    before = runs.filter(F.col("run_seq") < run_seq).select(F.col("run_id").alias(run_col), F.col("run_seq").alias("valid_from"))
    return rows.join(before, run_col)


def seeds_before(people: DataFrame, links: DataFrame, runs: DataFrame, run_seq: int) -> DataFrame | None:
    """The seeds of a run: patients (place) and links (place) of earlier runs, in the order of their runs and places."""
    ordered = lambda df: as_of(df, runs, run_seq).withColumn("place", F.concat_ws("/", F.lpad(F.col("valid_from").cast("string"), 12, "0"), "place"))
    seeds = seeds_from(ordered(people), ordered(links))
    return None if seeds.isEmpty() else numbered(seeds, ["place"]).withColumnRenamed("arrival_seq", "seq").drop("place")


def person_index(index: DataFrame, links: DataFrame, runs: DataFrame, run_seq: int) -> DataFrame:
    """The persons that are known after run run_seq, each with the run it is valid from and its records up to then."""
    counts = as_of(links, runs, run_seq + 1).groupBy("umpi").agg(F.count("*").cast("int").alias("linked_record_count"))
    return as_of(index, runs, run_seq + 1).drop("linked_record_count").join(counts, "umpi", "left").withColumn("linked_record_count", F.coalesce("linked_record_count", F.lit(0)))


def filled(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Patient rows (umpi) with what they lack of name, gender and postal code from their person's index record.

    Their birth date is the index record's. index: one row for each umpi.
    """
    names = [c for c in ("given_name", "family_name", "gender", "postal_code") if c in index.columns]
    known = index.select("umpi", F.col("birth_date").alias("_birth_date"), *(F.col(c).alias(f"_{c}") for c in names))
    out = rows.join(known, "umpi", "left")
    own = {c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}")) for c in names}
    return out.withColumns({**own, "birth_date": F.col("_birth_date")}).drop("_birth_date", *(f"_{c}" for c in names))
