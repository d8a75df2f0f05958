"""Conformed master data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import codes, text
from ledgerflow.functions.predicates import bridge_salesperson, listed_goal, valid_salesperson
from ledgerflow.operators.joins import lookup, match_key
from ledgerflow.operators.scd2 import scd2_apply
from ledgerflow.operators.setops import union_labelled
from ledgerflow.plans.warehouse import Warehouse, model


def with_branch(w: Warehouse, df: DataFrame, need: set[str]) -> DataFrame:
    return lookup(
        df, w.stage("branch_obpl"), {"branch_id": "branch_id"},
        {"branch_name": F.lower("branch_name"), "branch_nomenclature": F.lower("nomenclature")}, need,
    )


def with_partner(w: Warehouse, df: DataFrame, key: str, need: set[str], **outputs: str) -> DataFrame:
    """Attach partner attributes; outputs map output name -> partner column."""
    used = {out: source for out, source in outputs.items() if out in need}
    if not used:
        return df
    partner = w.model("partner", "partner_code", *dict.fromkeys(used.values()))
    return lookup(df, partner, {key: "partner_code"}, {o: F.col(s) for o, s in used.items()})


ITEM_HIERARCHY = (
    "item_name", "family_code", "family_name", "class_code", "class_name",
    "sub_class_code", "sub_class_name", "abc_curve", "unit_of_measure",
)


def item_labels(w: Warehouse, need: set[str], *extra: str) -> dict[str, DataFrame]:
    """The item columns that are needed, by the lines' item key; nothing if none is."""
    used = [c for c in (*ITEM_HIERARCHY, *extra) if c in need]
    return {"item_code": w.model("item", "item_code", *used)} if used else {}


def with_item(w: Warehouse, df: DataFrame, need: set[str], *extra: str, how: str = "left") -> DataFrame:
    used = [c for c in (*ITEM_HIERARCHY, *extra) if c in need]
    if not used and how == "left":
        return df
    return df.join(w.model("item", "item_code", *used), "item_code", how)


@model("partner")
def partner(w: Warehouse, need: set[str]) -> DataFrame:
    p = w.stage("business_partner_ocrd")
    df = p.select(
        "partner_code",
        F.lower("partner_name").alias("partner_name"),
        codes.translate_code(F.col("partner_type"), codes.PARTNER_TYPE).alias("partner_type"),
        "group_code",
        "salesperson_code",
        F.lower("franchise_name").alias("franchise_name"),
        codes.translate_code(F.col("presale_channel"), codes.PRESALE_CHANNEL).alias("presale_channel"),
        codes.translate_code(F.col("show_in_bi"), codes.SIM_NAO).alias("show_in_bi"),
        F.col("cpf_cnpj").alias("cpf_cnpj_official"),
        text.tax_id_normalized(F.col("password"), F.col("partner_code")).alias("cpf_cnpj_normalized"),
        "registration_date",
        "updated_date",
    )
    groups = w.stage("partner_group_ocrg")
    return lookup(df, groups, {"group_code": "group_code"}, {"group_name": F.lower("group_name")}, need)


@model("item")
def item(w: Warehouse, need: set[str]) -> DataFrame:
    def flag(name: str, labels=codes.YES_NO):
        return codes.translate_code(F.col(name), labels)

    df = w.stage("item_master_oitm").select(
        "item_code",
        F.lower("item_name").alias("item_name"),
        F.col("family").alias("family_code"),
        F.col("class").alias("class_code"),
        F.col("sub_class").alias("sub_class_code"),
        F.lower("abc_curve").alias("abc_curve"),
        F.lower("unit_of_measure").alias("unit_of_measure"),
        F.col("gross_weight").alias("unit_weight_kg"),
        text.lenient_int(F.col("lead_time_days")).alias("lead_time_days"),
        flag("inventory_item").alias("is_stockable"),
        flag("sales_item").alias("is_sellable"),
        flag("purchase_item").alias("is_purchased"),
        flag("made_to_order", codes.MADE_TO_ORDER).alias("is_made_to_order"),
        flag("active").alias("valid_for_use"),
        flag("inactive").alias("blocked"),
        "manufacturer_code",
    )
    for level, staging in (("family", "item_family"), ("class", "item_class"), ("sub_class", "item_sub_class")):
        code, name = f"{level}_code", f"{level}_name"
        df = lookup(df, w.stage(staging), {code: code}, {name: F.lower(name)}, need)
    makers = w.stage("manufacturer_omrc")
    return lookup(
        df, makers, {"manufacturer_code": "manufacturer_code"},
        {"manufacturer_name": F.lower("manufacturer_name")}, need,
    )


@model("item_price_list")
def item_price_list(w: Warehouse, need: set[str]) -> DataFrame:
    prices = w.stage("item_price_itm1").withColumnRenamed("price", "list_price")
    return lookup(
        prices, w.stage("price_list_opln"), {"price_list_number": "price_list_number"},
        {"price_list_name": F.col("price_list_name")}, need,
    )


@model("warehouse")
def warehouse(w: Warehouse, need: set[str]) -> DataFrame:
    df = w.stage("warehouse_owhs").select(
        "warehouse_code",
        F.lower("warehouse_name").alias("warehouse_name"),
        "branch_id",
        "store_code",
        codes.translate_code(F.col("inactive"), codes.YES_NO).alias("inactive"),
    )
    df = with_branch(w, df, need)
    return lookup(df, w.stage("store"), {"store_code": "store_code"}, {"store_name": F.lower("store_name")}, need)


@model("user")
def user(w: Warehouse, need: set[str]) -> DataFrame:
    return w.stage("user_ousr").withColumn("user_name", F.lower("user_name"))


@model("employee")
def employee(w: Warehouse, need: set[str]) -> DataFrame:
    name = F.col("salesperson_name")
    return (
        w.stage("salesperson_oslp")
        .where(valid_salesperson(F.col("salesperson_code")))
        .select(
            F.col("salesperson_code").alias("employee_code"),
            text.canonical_name(name).alias("employee_name"),
            name.alias("sap_full_name"),
            text.active_status(name).alias("status"),
        )
    )


@model("standardized_store")
def standardized_store(w: Warehouse, need: set[str]) -> DataFrame:
    mapping = w.stage("store_mapping").select(
        F.col("old_store_name").alias("store_name"), F.lower("new_store_name").alias("new_store_name")
    )
    return (
        w.stage("store")
        .join(mapping, "store_name", "left")
        .select("store_code", F.lower("store_name").alias("old_store_name"), "new_store_name")
    )


def store_label():
    return F.coalesce(F.col("new_store_name"), F.col("old_store_name"))


def goal_rows(w: Warehouse) -> DataFrame:
    """Both goal sheets with their channel, without blank and discontinued lines."""
    keep = listed_goal(F.col("date"), F.col("salesperson"), w.params.goal_min_year)
    sheets = {c: w.stage(f"{c}_goals").where(keep) for c in ("wholesale", "retail")}
    return union_labelled(sheets, "channel")


@model("goal_name_entry")
def goal_name_entry(w: Warehouse, need: set[str]) -> DataFrame:
    """First goal per name; spellings that differ in accents only are one name.

    Goals are first reduced to one row per spelling by a hash aggregation, so
    a name with very many goals stays cheap.
    """
    name = text.normalized_name(F.col("salesperson"))
    per_spelling = goal_rows(w).groupBy(name.alias("normalized_name")).agg(F.min("date").alias("first_goal"))
    return per_spelling.groupBy(match_key(F.col("normalized_name")).alias("_key")).agg(
        F.min("normalized_name").alias("normalized_name"), F.min("first_goal").alias("first_goal")
    )


def bridge_candidates(w: Warehouse) -> DataFrame:
    """Salespeople with a known store, one row per code, without validity."""
    code, name, store = (F.col(c) for c in ("salesperson_code", "salesperson_name", "store_code"))
    people = w.stage("salesperson_oslp").where(bridge_salesperson(code, name, store)).select(
        code, name, F.trim(store).alias("store_code"),
        text.normalized_name(name).alias("normalized_name"),
        text.name_segment(name, 2).alias("store_text"),
        text.name_segment(name, 3).alias("role"),
    )
    return lookup(
        people, w.model("standardized_store"), {"store_code": "store_code"}, {"store_name": store_label()}
    ).withColumn("source", F.lit("sap_oslp"))


@model("salesperson_bridge")
def salesperson_bridge(w: Warehouse, need: set[str]) -> DataFrame:
    """First load: every version starts at the person's first goal, within bounds."""
    first = w.model("goal_name_entry").select(
        match_key(F.col("normalized_name")).alias("_key"), "first_goal"
    )
    people = bridge_candidates(w).withColumn("_key", match_key(F.col("normalized_name")))
    start = F.coalesce(
        F.greatest(F.col("first_goal"), F.when(F.col("first_goal").isNotNull(), F.lit(w.params.bridge_floor))),
        F.lit(w.params.bridge_default),
    )
    return people.join(first, "_key", "left").withColumn("valid_from", start)


def salesperson_bridge_step(w: Warehouse, current: DataFrame) -> DataFrame:
    """Forward run on an existing bridge: close moved salespeople, open new versions."""
    incoming = bridge_candidates(w)
    for c in ("valid_from", "valid_to"):
        incoming = incoming.withColumn(c, F.lit(None).cast("date"))
    master = w.stage("salesperson_oslp").select("salesperson_code", "store_code")
    return scd2_apply(current, incoming, master, "salesperson_code", "store_code", w.params.run_date)

