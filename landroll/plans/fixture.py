"""The property model expressed over the TPC-H-like test tables.

The test data has no property tables, so the monthly cycle is played on

  feed   one parcel per order: admid = order key; mailing address key
         (a, ci, st) = (market segment, nation name, region name);
         owner = customer name; attr = account balance (varies inside a key).
  pid    production identities: keys outside region AFRICA; HOUSEHOLD and
         MACHINERY keys are flagged inactive.
  pent   production entities: owners with a balance below 5000.
  ppar   production parcels: orders before 1999 outside nation 11 whose
         identity and entity exist in production.
  d      the month's delta: orders from 1998 on, except segment MACHINERY.
  dele   the delete list: orders of priority 5-LOW.

Joins on keys that may be hot (mailing keys, owners, the ids they resolve to)
are salted by the key's own row count, see ``operators.joins``.

Every frame is built with the library operators, lazily, from the parquet
files, so each query's work grows with the tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landroll.functions.address import compose, make_point, match_address_raw, normalize_address
from landroll.functions.cast import ColumnSpec, coalesce_defaults, force_not_null, typed_cast
from landroll.operators.dedup import distinct_rows, keep_first
from landroll.operators.enrich import left_enrich, memo_key, standardize_batches, standardize_once
from landroll.operators.joins import first_match, hot_keys, lookup_first, multi_match_report, salted_join
from landroll.operators.keys import assign_ids, next_id
from landroll.operators.merge import count_ops, existing_keys, get_or_insert, missing_keys, reactivate, upsert
from landroll.operators.prune import delete_by_keys, drop_orphans, flag_orphans, null_references, orphans
from landroll.operators.refcounts import apply_changes, childless, count_references, flag_listed, held, reference_changes
from landroll.operators.quality import cascade_delete, check_fk, check_lengths, check_not_null, check_unique
from landroll.plans.fixture_files import cycle_from_files, cycle_table, month_trio
from landroll.plans.relate import audit_stitch, check_trio, flatten, project, stitch_feed
from landroll.session import stage, stage_path
from landroll.sources.buckets import Buckets, attach, write_bucketed
from landroll.sources.delimited import load_typed, read_delete_list, read_standardized, write_address_extract
from landroll.sources.schemas import STD_COLUMNS

ADDR = ["a", "ci", "st"]
OWNER = ["owner", "identity_id"]
DELTA_FROM = "1998-01-01"
PRODUCTION_BEFORE = "1999-01-01"
BUCKETS = Buckets("admid", 16)


class Scenario:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- base frames ---------------------------------------------------
    @cached_property
    def feed(self) -> DataFrame:
        """The stitched monthly feed, staged once like the stitched table of a real run.

        Queries that read the feed only once use ``feed_view`` directly.
        """
        return stage(self.feed_view, "feed")

    @cached_property
    def feed_view(self) -> DataFrame:
        o, c = self.table("orders"), self.table("customer")
        n, r = self.table("nation"), self.table("region")
        return (o.join(c, o.o_custkey == c.c_custkey)
                .join(n, c.c_nationkey == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .select(o.o_orderkey.alias("admid"), c.c_custkey, c.c_name.alias("owner"),
                        c.c_mktsegment.alias("a"), n.n_name.alias("ci"), r.r_name.alias("st"),
                        c.c_nationkey.alias("nk"), c.c_acctbal.alias("attr"),
                        o.o_totalprice.alias("price"), o.o_orderpriority.alias("pri"),
                        o.o_orderstatus.alias("stat"), o.o_orderdate.alias("dt")))

    # Delta trio built from the whole feed (keep-first identity, entity, ids).
    @cached_property
    def ident_counted(self) -> DataFrame:
        first = keep_first(self.feed.select(*ADDR, "attr"), ADDR, count_col="n")
        return assign_ids(first, ADDR)

    @cached_property
    def ident(self) -> DataFrame:
        return self.ident_counted.select("id", *ADDR, "attr")

    @cached_property
    def ident_hot(self) -> DataFrame:
        return hot_keys(self.ident_counted, ADDR, count_col="n")

    @cached_property
    def feed_resolved(self) -> DataFrame:
        dim = self.ident.select(*ADDR, F.col("id").alias("identity_id"))
        return salted_join(self.feed, dim, ADDR, "left", hot=self.ident_hot, salt_cols=["admid"])

    @cached_property
    def ent_counted(self) -> DataFrame:
        first = keep_first(self.feed_resolved.select(*OWNER), OWNER, count_col="n")
        return assign_ids(first, OWNER)

    @cached_property
    def ent(self) -> DataFrame:
        return self.ent_counted.select("id", *OWNER)

    @cached_property
    def feed_keyed(self) -> DataFrame:
        dim = self.ent.select(*OWNER, F.col("id").alias("entity_id"))
        hot = hot_keys(self.ent_counted, OWNER, count_col="n")
        return salted_join(self.feed_resolved, dim, OWNER, "left", hot=hot, salt_cols=["admid"])

    # Production state.
    @cached_property
    def pid(self) -> DataFrame:
        first = keep_first(self.feed.where(F.col("st") != "AFRICA").select(*ADDR, "attr"), ADDR)
        flagged = first.withColumns({
            "inactive": F.when(F.col("a").isin("HOUSEHOLD", "MACHINERY"), F.lit(True)).cast("boolean"),
            "primary_name": F.lit(None).cast("string"),
            "rental_count": F.lit(None).cast("int"),
        })
        return assign_ids(flagged, ADDR)

    @cached_property
    def pent(self) -> DataFrame:
        rows = salted_join(self.feed.where(F.col("attr") < 5000),
                           self.pid.select(*ADDR, F.col("id").alias("identity_id")), ADDR, "inner",
                           hot=self.ident_hot, salt_cols=["admid"])
        return assign_ids(distinct_rows(rows, OWNER), OWNER)

    @cached_property
    def ppar(self) -> DataFrame:
        f = self.feed.where((F.col("dt") < F.lit(PRODUCTION_BEFORE).cast("timestamp_ntz")) & (F.col("nk") != 11))
        f = salted_join(f, self.pid.select(*ADDR, F.col("id").alias("identity_id")), ADDR, "inner",
                        hot=self.ident_hot, salt_cols=["admid"])
        rows = (salted_join(f, self.pent.select(*OWNER, F.col("id").alias("entity_id")), OWNER, "inner",
                            salt_cols=["admid"])
                .select("admid", "price", (F.col("stat") == "F").alias("flag"), "identity_id", "entity_id"))
        return assign_ids(rows, ["admid"])

    @cached_property
    def d(self) -> DataFrame:
        return self.feed.where((F.col("dt") >= F.lit(DELTA_FROM).cast("timestamp_ntz")) & (F.col("a") != "MACHINERY"))

    @cached_property
    def dele(self) -> DataFrame:
        return self.table("orders").where(F.col("o_orderpriority") == "5-LOW").select(F.col("o_orderkey").alias("admid"))

    # Merge pass 1: identities and entities.
    @cached_property
    def delta_ident(self) -> DataFrame:
        return keep_first(self.d.select(*ADDR, "attr"), ADDR, count_col="n")

    @cached_property
    def id2_and_new(self) -> tuple[DataFrame, DataFrame]:
        cands = self.delta_ident.drop("n")
        return get_or_insert(self.pid, cands, ADDR, defaults={"primary_name": F.lit(""), "rental_count": F.lit(0)})

    @cached_property
    def id2(self) -> DataFrame:
        return self.id2_and_new[0]

    @cached_property
    def d_identity(self) -> DataFrame:
        hot = hot_keys(self.delta_ident, ADDR, count_col="n")
        return lookup_first(self.d, self.id2, ADDR, out_col="identity_id", hot=hot, salt_cols=["admid"])

    @cached_property
    def ent2_and_new(self) -> tuple[DataFrame, DataFrame]:
        cands = distinct_rows(self.d_identity, OWNER)
        return get_or_insert(self.pent, cands, OWNER)

    @cached_property
    def ent2(self) -> DataFrame:
        return self.ent2_and_new[0]

    @cached_property
    def dfk(self) -> DataFrame:
        keyed = lookup_first(self.d_identity, self.ent2, OWNER, out_col="entity_id", salt_cols=["admid"])
        return stage(keyed.select("admid", (F.col("price") * 2).alias("price"), "identity_id", "entity_id"), "delta_fk")

    # Merge pass 2, deletes and sweeps.
    @cached_property
    def par2(self) -> DataFrame:
        delta = self.dfk.withColumn("flag", F.lit(None).cast("boolean"))
        return stage(upsert(self.ppar, delta, "admid", checked=True), "parcel_upserted")

    @cached_property
    def ppar_bucketed(self) -> DataFrame:
        """The production parcels as the store keeps them: bucketed by admid through the catalog."""
        path = stage_path(self.spark, "parcel_bucketed")
        write_bucketed(self.ppar, path, BUCKETS)
        return attach(self.spark, path, self.ppar.schema, BUCKETS)

    @cached_property
    def par3(self) -> DataFrame:
        return delete_by_keys(self.par2, self.dele, "admid")

    @cached_property
    def id3(self) -> DataFrame:
        return flag_orphans(reactivate(self.id2, matched_first(self.id2, self.delta_ident, ADDR)),
                            self.par3, "identity_id")

    @cached_property
    def ent3(self) -> DataFrame:
        return drop_orphans(self.ent2, self.par3, "entity_id")


def matched_first(state: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Ids of the first match of each key that the delta has."""
    return first_match(state, keys).join(delta.select(*keys).distinct(), keys, "left_semi").select("id")


def _nullif(c, v):
    return F.nullif(F.col(c), F.lit(v))


# ---- one function per query key ------------------------------------------

def q_feed_scan(s: Scenario) -> DataFrame:
    return s.feed_view


def q_feed_text_roundtrip(s: Scenario) -> DataFrame:
    """Orders as a ``||``-separated text file (header, no quoting), read back by the strict typed reader."""
    o = s.table("orders")
    text = o.select(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus",
                    F.format_string("%.2f", "o_totalprice").alias("o_totalprice"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")
    path = stage_path(s.spark, "orders_text")
    text.write.option("sep", "||").option("header", True).option("quote", "").option("escape", "").csv(path)
    specs = [ColumnSpec("o_orderkey", "long"), ColumnSpec("o_custkey", "long"),
             ColumnSpec("o_orderstatus", "char", length=1),
             ColumnSpec("o_totalprice", "decimal", precision=12, scale=2), ColumnSpec("o_orderdate", "date"),
             ColumnSpec("o_orderpriority", "string", length=15)]
    return load_typed(s.spark, path, specs, "||", forced=["o_orderpriority"], required=["o_orderkey"],
                      mode="strict", name="orders_text").rows


def q_force_not_null(s: Scenario) -> DataFrame:
    o = s.table("orders").select("o_orderkey", _nullif("o_orderstatus", "F").alias("s"),
                                 _nullif("o_orderpriority", "1-URGENT").alias("p"))
    return force_not_null(o, ["s"])


def q_address_extract(s: Scenario) -> DataFrame:
    """The standardiser's input file (tab-separated, header, CRLF) written from the feed and read back."""
    rows = s.feed_view.select("admid", compose("owner", "a").alias("street"),
                         _nullif("pri", "1-URGENT").alias("secondary"), F.col("ci").alias("city"),
                         F.col("st").alias("state"))
    path = stage_path(s.spark, "address_extract")
    write_address_extract(rows, path)
    specs = [ColumnSpec("admid", "long")] + [ColumnSpec(c, "string") for c in ("street", "secondary", "city", "state")]
    return load_typed(s.spark, path, specs, "\t", mode="strict", name="address_extract").rows


def q_standardized_load(s: Scenario) -> DataFrame:
    """A 60-column standardiser output file built from the feed, read back by the strict reader."""
    given = {"admid": F.col("admid").cast("string"), "delivery_line_1": F.col("a"), "city_name": F.col("ci"),
             "state_abbreviation": F.col("st"), "zipcode": F.col("nk").cast("string"),
             "latitude": F.format_string("%.6f", F.col("attr") / 1000),
             "longitude": F.format_string("%.6f", -F.col("attr") / 100)}
    rows = s.feed_view.select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in STD_COLUMNS])
    path = stage_path(s.spark, "standardized")
    rows.write.option("sep", "\t").option("header", True).option("quote", "").option("escape", "").csv(path)
    std = read_standardized(s.spark, path, mode="strict").rows
    return std.select("admid", "delivery_line_1", "city_name", "state_abbreviation", "zipcode", "latitude",
                      "longitude", "county_name")


def q_std_enrich(s: Scenario) -> DataFrame:
    std = s.table("nation").where(F.col("n_regionkey") != 0)
    return left_enrich(s.table("customer"), std, "c_nationkey", "n_nationkey",
                       {"n_name": "std_city"}).select("c_custkey", "std_city", "matched")


def q_delete_list(s: Scenario) -> DataFrame:
    """The delete list written as a text file (header line, one admid per line), read back by its reader."""
    path = stage_path(s.spark, "deletes_text")
    s.dele.write.option("header", True).csv(path)
    return read_delete_list(s.spark, path, mode="strict").rows


def q_standardize_hook(s: Scenario) -> DataFrame:
    """A per-batch callable run over every customer."""
    def tidy(pdf):
        return pdf.assign(std=pdf["c_mktsegment"].str.title() + ", " + pdf["c_name"].str.upper())[["c_custkey", "std"]]
    rows = s.table("customer").select("c_custkey", "c_mktsegment", "c_name")
    return standardize_batches(rows, tidy, "c_custkey long, std string")


def q_standardize_memo(s: Scenario) -> DataFrame:
    """Customers' addresses (segment, nation): those of the first ten nations are in the memo, each other one is asked once."""
    def tidy(pdf):
        return pdf.assign(std=pdf["c_mktsegment"].str.title() + " " + pdf["nation"])[["c_custkey", "std"]]

    def ask(addresses: DataFrame) -> DataFrame:
        return standardize_batches(addresses, tidy, "c_custkey long, std string")

    rows = s.table("customer").select("c_custkey", _nullif("c_mktsegment", "BUILDING").alias("c_mktsegment"),
                                      F.col("c_nationkey").cast("string").alias("nation"))
    names = ("c_mktsegment", "nation")
    known = rows.where("cast(nation as int) < 10").select(*[F.coalesce(c, F.lit("")).alias(memo_key(c)) for c in names])
    memo = known.distinct().withColumn("std", F.concat(F.lit("known "), memo_key("nation")))
    found, fresh = standardize_once(rows, ask, "c_custkey", names, memo)
    return found.withColumn("n_asked", fresh.select(F.count(F.lit(1))).scalar())


def q_stitch(s: Scenario) -> DataFrame:
    std = s.table("customer").where(F.col("c_acctbal") >= 0).select("c_custkey", "c_name", "c_mktsegment")
    return stitch_feed(s.table("orders"), std, feed_key="o_custkey", std_key="c_custkey")


def q_stitch_audit(s: Scenario) -> DataFrame:
    """What the stitch of orders with customers not in debt drops or multiplies; every eighth customer comes twice."""
    c = s.table("customer")
    std = c.where("c_acctbal >= 0").unionByName(c.where("c_custkey % 8 = 0")).select("c_custkey")
    return audit_stitch(s.table("orders"), std, feed_key="o_custkey", std_key="c_custkey")


def q_reject_provenance(s: Scenario) -> DataFrame:
    """Rejects of a load from two files: which of them each stands in, and its line if that is malformed."""
    nk = F.col("c_nationkey")
    text = s.table("customer").select(
        F.col("c_custkey").cast("string").alias("k"),
        F.when(nk < 6, "many").when(nk < 12, F.concat_ws("||", F.lit("1"), F.lit("2"))).otherwise(nk.cast("string")).alias("n"))
    lines = text.select("k", F.concat_ws("||", "k", "n").alias("k||n"))
    paths = []
    for half, name in enumerate(("east", "west")):
        paths.append(f"{stage_path(s.spark, 'halves')}/{name}")
        (lines.where(F.col("k").cast("int") % 2 == half).drop("k").write.option("sep", "\t").option("header", True)
         .option("quote", "").option("escape", "").csv(paths[-1]))
    got = load_typed(s.spark, paths, [ColumnSpec("k", "long"), ColumnSpec("n", "int")], "||", mode="quarantine",
                     name="provenance")
    return got.rejects.select("k", "raw_line", F.array_join(F.sort_array("problems"), ",").alias("problems"),
                              F.regexp_extract("file", "/(east|west)/[^/]+$", 1).alias("half"),
                              (F.col("block_start") >= 0).alias("placed"))


def q_compose_street(s: Scenario) -> DataFrame:
    d = s.table("documents")
    return d.select("doc_id", compose(_nullif("lang", "en"), "source", "text").alias("street"))


def q_compose_address1(s: Scenario) -> DataFrame:
    p = s.table("part")
    return p.select("p_partkey", compose("p_brand", _nullif("p_type", "ECONOMY"), F.lit(""), "p_name",
                                         F.lit("  ")).alias("address1"))


def q_compose_address2(s: Scenario) -> DataFrame:
    p = s.table("part")
    return p.select("p_partkey", compose(_nullif("p_type", "ECONOMY"), F.col("p_size").cast("string")).alias("address2"))


def q_rename_cols(s: Scenario) -> DataFrame:
    """The renames of the standardiser's extract, from feed columns of the supplier's names."""
    from landroll.plans.relate import MAIL_RENAMES, MAIL_STREET_PARTS, address_extract
    values = dict(zip(MAIL_RENAMES, ("c_mktsegment", "c_name", "c_phone")))
    c = s.table("customer").withColumn("c_phone", F.lit("x"))
    feed = c.select(F.col("c_custkey").alias("admid"), *[F.col(v).alias(k) for k, v in values.items()],
                    *[F.lit(None).cast("string").alias(p) for p in MAIL_STREET_PARTS])
    return address_extract(feed).select(F.col("admid").alias("c_custkey"), "secondary", "city")


def q_project_identity(s: Scenario) -> DataFrame:
    return project(s.feed_view, {"mail_address": "a", "mail_city": "ci", "mail_state": "st", "attr": "attr"})


def q_project_parcel(s: Scenario) -> DataFrame:
    return project(s.feed_view, {"admid": "admid", "total_value": "price", "last_sale": "dt", "record_type": "pri"})


def q_coalesce_defaults(s: Scenario) -> DataFrame:
    c = s.table("customer").select("c_custkey", _nullif("c_mktsegment", "BUILDING").alias("seg"),
                                   _nullif("c_nationkey", 3).alias("nk"))
    return coalesce_defaults(c, ["seg"])


def q_identity_insert(s: Scenario) -> DataFrame:
    return s.id2_and_new[1].select("id", *ADDR, "primary_name", "rental_count")


def q_upsert_parcel_null_overwrite(s: Scenario) -> DataFrame:
    return s.par2.select("admid", "flag", "op")


def q_make_point(s: Scenario) -> DataFrame:
    c = s.table("customer").select("c_custkey", F.nullif(F.col("c_nationkey").cast("double"), F.lit(3.0)).alias("x"),
                                   _nullif("c_acctbal", 1863.84).alias("y"))
    p = c.select("c_custkey", make_point("x", "y").alias("pt"))
    return p.select("c_custkey", F.col("pt.lon").alias("lon"), F.col("pt.lat").alias("lat"),
                    F.col("pt.srid").alias("srid"))


def q_match_address_raw(s: Scenario) -> DataFrame:
    c = s.table("customer")
    return c.select("c_custkey", match_address_raw(_nullif("c_mktsegment", "BUILDING"), F.lit(""), "c_name").alias("raw"))


def q_normalize_address(s: Scenario) -> DataFrame:
    c = s.table("customer")
    return c.select("c_custkey", normalize_address(F.concat_ws(" ", "c_mktsegment", F.lit("Street"), "c_name")).alias("norm"))


def q_typed_cast(s: Scenario) -> DataFrame:
    c = s.table("customer").select("c_custkey", F.substring("c_name", 10, 1 << 30).alias("ok"),
                                   F.col("c_mktsegment").alias("bad"))
    typed, _ = typed_cast(c, [ColumnSpec("ok", "long"), ColumnSpec("bad", "int")], key="c_custkey",
                          keep=["c_custkey"])
    return typed.select("c_custkey", "ok", "bad")


def _text_file(df: DataFrame, path: str) -> str:
    """``df`` as a ``||`` file in which blanks and empty strings are written as they are."""
    (df.write.option("sep", "||").option("header", True).option("quote", "").option("escape", "")
     .option("emptyValue", "").option("nullValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def _loaded(s: Scenario, text: DataFrame, specs: list[ColumnSpec], name: str) -> DataFrame:
    """Every row of a text file after the load: its values, or NULLs with the problems of a reject."""
    path = _text_file(text, stage_path(s.spark, name))
    got = load_typed(s.spark, path, specs, "||", mode="quarantine", name=name)
    rejects = got.rejects.select(specs[0].name, F.array_join(F.sort_array("problems"), ",").alias("problems"))
    return got.rows.withColumn("problems", F.lit("")).unionByName(rejects, allowMissingColumns=True)


def q_cast_blank_rules(s: Scenario) -> DataFrame:
    """Empty fields are NULL; blanks alone are a bad number, date or boolean, and a value in a char column."""
    nk = F.col("c_nationkey")
    text = s.table("customer").select(
        F.col("c_custkey").cast("string").alias("k"),
        F.when(nk < 4, "   ").when(nk < 8, "").otherwise(nk.cast("string")).alias("num"),
        F.when(nk.between(8, 10), " ").when(nk < 14, "").otherwise("2020-02-03").alias("day"),
        F.when(nk.between(10, 12), "  ").when(nk < 16, "").otherwise(" Yes").alias("flag"),
        F.when(nk > 20, "  ").when(nk > 17, "").otherwise("ab").alias("code"))
    specs = [ColumnSpec("k", "long"), ColumnSpec("num", "int"), ColumnSpec("day", "date"), ColumnSpec("flag", "bool"),
             ColumnSpec("code", "char", length=2)]
    return _loaded(s, text, specs, "cast_blank_rules")


def q_varchar_trim(s: Scenario) -> DataFrame:
    """Blanks over a text's length are trimmed; anything else over it is a reject."""
    text = s.table("part").select(
        F.col("p_partkey").cast("string").alias("k"),
        F.concat(F.lit("ab"), F.when(F.col("p_size") < 15, "      ").when(F.col("p_size") < 30, "  c  ")
                 .otherwise(" ")).alias("v"))
    return _loaded(s, text, [ColumnSpec("k", "long"), ColumnSpec("v", "string", length=4)], "varchar_trim")


def q_length_check(s: Scenario) -> DataFrame:
    return check_lengths(s.table("customer"), {"c_mktsegment": 8}, "c_custkey")


def q_resolve_identity(s: Scenario) -> DataFrame:
    return s.feed_resolved.select("admid", "identity_id")


def q_resolve_entity(s: Scenario) -> DataFrame:
    return s.feed_keyed.select("admid", "identity_id", "entity_id")


def q_flatten_delta(s: Scenario) -> DataFrame:
    return _with_attributes(s.feed_keyed.select("admid", "identity_id", "entity_id"), s.ident, s.ent).select(
        "admid", *ADDR, "attr", "owner")


def _with_attributes(parcel: DataFrame, identity: DataFrame, entity: DataFrame) -> DataFrame:
    """Parcels with the attributes of their identity and entity."""
    i = identity.select(F.col("id").alias("identity_id"), *ADDR, "attr")
    e = entity.select(F.col("id").alias("entity_id"), "owner")
    return salted_join(salted_join(parcel, i, ["identity_id"], "inner", salt_cols=["admid"]),
                       e, ["entity_id"], "inner", salt_cols=["admid"])


def q_salted_resolve(s: Scenario) -> DataFrame:
    """Identity resolution of the whole feed with every key salted, the largest into hundreds of salts."""
    dim = s.ident.select(*ADDR, F.col("id").alias("identity_id"))
    hot = hot_keys(s.ident_counted, ADDR, count_col="n", rows_per_salt=0)
    return salted_join(s.feed, dim, ADDR, "left", hot=hot, salt_cols=["admid"], rows_per_salt=1).select(
        "admid", "identity_id")


def q_identity_lookup(s: Scenario) -> DataFrame:
    return lookup_first(s.d, s.pid, ADDR, out_col="identity_id", salt_cols=["admid"]).select("admid", "identity_id")


def q_entity_lookup(s: Scenario) -> DataFrame:
    with_ident = lookup_first(s.d, s.pid, ADDR, out_col="identity_id", salt_cols=["admid"])
    return (lookup_first(with_ident, s.pent, OWNER, out_col="entity_id", salt_cols=["admid"])
            .select("admid", "entity_id"))


def q_lookup_pruned(s: Scenario) -> DataFrame:
    """The entity lookup with the state reduced to the delta's keys before it is grouped."""
    with_ident = lookup_first(s.d, s.pid, ADDR, out_col="identity_id", salt_cols=["admid"], prune=True)
    return (lookup_first(with_ident, s.pent, OWNER, out_col="entity_id", salt_cols=["admid"], prune=True)
            .select("admid", "identity_id", "entity_id"))


def q_parcel_update_set(s: Scenario) -> DataFrame:
    return existing_keys(s.ppar, s.d, "admid")


def q_parcel_insert_set(s: Scenario) -> DataFrame:
    return missing_keys(s.ppar, s.d, "admid")


def q_attach_fks(s: Scenario) -> DataFrame:
    return s.dfk.select("admid", "identity_id", "entity_id")


def q_orphan_identities(s: Scenario) -> DataFrame:
    return orphans(s.table("customer"), s.table("events"), "user_id", "c_custkey").select("c_custkey")


def q_orphan_entities(s: Scenario) -> DataFrame:
    return orphans(s.table("orders"), s.table("lineitem"), "l_orderkey", "o_orderkey").select("o_orderkey")


def q_delete_parcels(s: Scenario) -> DataFrame:
    return delete_by_keys(s.table("orders").select("o_orderkey"), s.dele, "o_orderkey", "admid")


def q_null_postcard_refs(s: Scenario) -> DataFrame:
    cards = s.table("lineitem").select("l_partkey", "l_linenumber", F.col("l_orderkey").alias("parcel_id"))
    return null_references(cards, s.dele, "parcel_id", "admid")


def q_distinct_identity_rows(s: Scenario) -> DataFrame:
    return distinct_rows(s.feed_view, [*ADDR, "attr"])


def q_keep_first_identity(s: Scenario) -> DataFrame:
    return keep_first(s.feed_view.select(*ADDR, "attr"), ADDR)


def q_distinct_entities(s: Scenario) -> DataFrame:
    return distinct_rows(s.feed_view, ["owner", *ADDR])


def q_distinct_admids(s: Scenario) -> DataFrame:
    return distinct_rows(s.table("lineitem").select(F.col("l_orderkey").alias("admid")))


def q_next_id(s: Scenario) -> DataFrame:
    o = s.table("orders")
    one = s.spark.range(1)
    full = one.select(F.lit("orders").alias("t"), next_id(o, "o_orderkey").alias("next_id"))
    none = o.where(F.col("o_orderkey") < 0)
    return full.unionByName(one.select(F.lit("empty").alias("t"), next_id(none, "o_orderkey").alias("next_id")))


def q_multi_match_report(s: Scenario) -> DataFrame:
    return multi_match_report(s.table("lineitem"), ["l_orderkey", "l_linenumber"])


def q_merge_counts(s: Scenario) -> DataFrame:
    return count_ops(s.par2)


def q_assign_ids(s: Scenario) -> DataFrame:
    keys = distinct_rows(s.table("lineitem"), ["l_orderkey", "l_linenumber"])
    return assign_ids(keys, ["l_orderkey", "l_linenumber"], base=100)


def q_check_unique(s: Scenario) -> DataFrame:
    return check_unique(s.table("lineitem"), ["l_orderkey", "l_linenumber"])


def q_check_not_null(s: Scenario) -> DataFrame:
    c = s.table("customer").select("c_custkey", _nullif("c_mktsegment", "BUILDING").alias("c_mktsegment"))
    return check_not_null(c, ["c_mktsegment"], "c_custkey")


def q_check_fk(s: Scenario) -> DataFrame:
    parents = s.table("orders").where(F.col("o_orderstatus") != "P")
    return check_fk(s.table("lineitem"), parents, "l_orderkey", "o_orderkey").select("l_orderkey", "l_partkey", "l_linenumber")


def q_cascade_delete(s: Scenario) -> DataFrame:
    removed = s.table("orders").where(F.col("o_orderpriority") == "1-URGENT")
    return cascade_delete(s.table("lineitem"), removed, "l_orderkey", "o_orderkey").select("l_orderkey", "l_partkey", "l_linenumber")


def q_reactivate_identity(s: Scenario) -> DataFrame:
    return reactivate(s.pid, matched_first(s.pid, s.delta_ident, ADDR)).select("id", "inactive")


def q_reactivate_first_match(s: Scenario) -> DataFrame:
    """Customers as identities, many per key (segment, nation), those in debt inactive: only the first of a
    key that a recent order names becomes active."""
    keys = ["c_mktsegment", "c_nationkey"]
    c = s.table("customer")
    state = c.select(F.col("c_custkey").alias("id"), *keys,
                     F.when(F.col("c_acctbal") < 0, F.lit(True)).alias("inactive"))
    recent = s.table("orders").where(F.col("o_orderdate") >= F.lit(DELTA_FROM).cast("timestamp_ntz"))
    delta = c.join(recent.select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_semi")
    return reactivate(state, matched_first(state, delta.where("c_mktsegment <> 'MACHINERY'"), keys)).select(
        "id", "inactive")


def q_entity_insert(s: Scenario) -> DataFrame:
    return s.ent2_and_new[1].select("id", *OWNER)


def q_upsert_parcel(s: Scenario) -> DataFrame:
    return s.par2.select("admid", "price", "identity_id", "entity_id")


def q_upsert_actions(s: Scenario) -> DataFrame:
    return s.par2.select("admid", "op")


def q_upsert_bucketed(s: Scenario) -> DataFrame:
    """The upsert on bucketed parcels, with foreign keys attached by admid and the delete list marked in the same join."""
    delta = s.d.select("admid", (F.col("price") * 2).alias("price"), F.lit(None).cast("boolean").alias("flag"))
    merged = upsert(s.ppar_bucketed, delta, "admid", ["price", "flag", "identity_id", "entity_id"],
                    attached=s.dfk.select("admid", "identity_id", "entity_id"), deletes=s.dele,
                    partitions=BUCKETS.count)
    return merged.select("id", "admid", "price", "flag", "identity_id", "entity_id", "op", "gone")


def q_upsert_null_keys(s: Scenario) -> DataFrame:
    """A delta in which every seventh order and the urgent ones have no key: they are inserts of their own."""
    o = s.table("orders")
    state = assign_ids(o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c")),
                       ["k"])
    lacks = (F.col("o_orderkey") % 7 == 0) | (F.col("o_orderpriority") == "1-URGENT")
    delta = o.select(F.when(~lacks, F.col("o_orderkey")).alias("k"), (-F.col("o_orderkey")).alias("c"))
    return upsert(state, delta, "k", ["c"]).select("id", "k", "c", "op")


def q_upsert_then_delete(s: Scenario) -> DataFrame:
    return s.par3.select("admid", "price", "op")


def q_deactivate_identities(s: Scenario) -> DataFrame:
    return s.id3.select("id", "inactive")


def q_sweep_incremental(s: Scenario) -> DataFrame:
    """Three months of new, moved and deleted orders: customers' counts moved month by month, flags swept each month.

    An order is of its customer and of the month of its date.
    """
    fks = {"customer": "cust", "month": "month"}
    o = s.table("orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("long").alias("cust"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("long").alias("month"),
        F.year("o_orderdate").alias("year"))
    children = o.where("year < 1996").drop("year")
    parents = s.table("customer").select(F.col("c_custkey").cast("long").alias("id"), F.lit(None).cast("boolean").alias("inactive"))
    references = stage(count_references(children, fks), "references")
    parents = flag_orphans(parents, references.where("parent = 'customer'"), "id")
    for m in (1, 2, 3):
        moves = o.where((F.col("year") < 1995 + m) & (F.col("k") % 16 == m)).withColumn("cust", F.col("cust") % 100 + 1)
        delta = o.where(F.col("year") == 1995 + m).unionByName(moves).drop("year")
        deletes = o.where(F.col("k") % 8 == m + 2).select("k")
        touched = delta.select("k").unionByName(deletes).distinct()
        new = delta.join(deletes.withColumn("gone", F.lit(True)), "k", "left")
        gone = F.col("gone").isNotNull()
        changes = reference_changes(children.join(touched, "k", "left_semi"), new, fks, gone)
        counted = stage(apply_changes(references, changes), "references_moved")
        references = held(counted)
        parents = flag_listed(parents, childless(counted, "customer"))
        children = stage(children.join(touched, "k", "left_anti").unionByName(new.where(~gone).drop("gone")), "children")
    counts = references.where("parent = 'customer'").select("id", "n")
    return parents.join(counts, "id", "left").select("id", "inactive", F.coalesce("n", F.lit(0)).alias("n"))


def q_drop_orphan_entities(s: Scenario) -> DataFrame:
    return s.ent3.select("id", *OWNER)


def q_full_cycle(s: Scenario) -> DataFrame:
    p = s.par3.select("admid", "price", "identity_id", "entity_id")
    return _with_attributes(p, s.id3, s.ent3).select(
        "admid", "price", "identity_id", "entity_id", "owner", *ADDR, "attr")


def q_cycle_from_files(s: Scenario) -> DataFrame:
    return cycle_from_files(s)


def q_cycle_parcel_full(s: Scenario) -> DataFrame:
    """Every column of the parcels that the file-based cycle publishes."""
    return cycle_table(s, "parcel", "parcel_location")


def q_cycle_identity_full(s: Scenario) -> DataFrame:
    return cycle_table(s, "identity", "mail_location")


def q_cycle_entity_full(s: Scenario) -> DataFrame:
    return cycle_table(s, "entity")


def q_trio_flatten(s: Scenario) -> DataFrame:
    """The month as identity, entity and parcel tables with ids, joined back to one row per parcel."""
    return flatten(month_trio(s)).select("admid", "identity_id", "entity_id", "mail_address", "mail_city", "mail_state",
                                         "mail_longitude", "mail_verified", "owner", "parcel_number")


def q_trio_checks(s: Scenario) -> DataFrame:
    """The rules of the trio over a month with missing record types and state names that are too long."""
    trio = month_trio(s, propertyusegroup=F.when(F.col("stat") != "P", F.col("pri")), propertyaddressstate=F.col("st"))
    return check_trio(trio).groupBy("table", "rule", "detail").agg(F.count(F.lit(1)).alias("n"))


def q_cycle_postcards(s: Scenario) -> DataFrame:
    return cycle_table(s, "postcard")


QUERY_FUNCS = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
