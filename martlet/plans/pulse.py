"""K2-K6: the order "pulses" as one parameterised job.

A pulse selects shipments of some retailers in a look-back window, joins
their line items and catalogue data, keeps those meeting a rule and not yet
in the sent ledger, and emits report rows plus the ledger rows to append.
Every step is a DataFrame join or filter; nothing is pulled to the driver.
The per-shipment files are a partitioned write (``write_split``), not a loop.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions import rules
from martlet.functions import time as tf
from martlet.functions.text import full_name
from martlet.operators import joins, windows
from martlet.plans.directory import Fallback, manager_directory
from martlet.session import AS_OF, cut_lineage
from martlet.sources.views import view


@dataclass(frozen=True)
class PulseConfig:
    """What differs between the pulse jobs is configuration, not code."""

    process_name: str
    retailer_ids: tuple[int, ...] = ()
    store_ids: tuple[int, ...] = ()
    states: tuple[str, ...] = ("complete", "shipped")
    window_days: int = 14
    # 'slot': local slot date; 'completed': completion time; 'completed_date': its local date
    window_basis: str = "slot"
    payment_methods: tuple[int, ...] = ()
    tenant_ids: tuple[str, ...] = ()
    platforms: tuple[str, ...] = ()
    line_rule: tuple[str, float, float] | None = None  # (mode, line_min, total_min)
    ledger_names: tuple[str, ...] = ()  # ledgers read for the anti join (default: own)
    scan_ledger: str | None = None  # over-limit: first-stage ledger of scanned shipments
    exclude_store_ids: tuple[int, ...] = ()  # e.g. "two retailers minus one store"
    zones: tuple[str, ...] = ()  # only stores of these operational zones
    exclude_zones: tuple[str, ...] = ()  # only stores of a known zone that is none of these
    slot_day: str = "utc"  # K3: the slot's day as stored ("utc") or in the report zone ("local")
    lines_by: str = "shipment_id"  # "order_id" reproduces the reference's join of lines by order (Q8)
    gate: str = "pay"  # which orders are alerted or listed, see ``payable``
    trigger: str = "12 minutes"
    fallback: Fallback = field(default_factory=Fallback)


@dataclass
class Sources:
    shipments: DataFrame
    line_items: DataFrame
    offers: DataFrame
    windows: DataFrame
    company_orders: DataFrame
    locked: DataFrame
    ledger: DataFrame
    directory: DataFrame
    limits: DataFrame | None = None
    stores: DataFrame | None = None  # (store_id, zone), read where a pulse names zones

    @staticmethod
    def fixture(spark: SparkSession, sf_dir: str, fb: Fallback = Fallback()) -> "Sources":
        v = lambda n: view(spark, sf_dir, n)
        directory = manager_directory(v("v_company"), v("v_company_manager"), v("v_user"), v("v_phone"), fb)
        return Sources(v("v_shipment"), v("v_line_item"), v("v_offer"), v("v_delivery_window"),
                       v("v_company_order"), v("v_locked_order"), v("v_ledger"), directory,
                       v("v_offer_limit"), v("v_store"))


def _scope(s: DataFrame, cfg: PulseConfig) -> DataFrame:
    if cfg.retailer_ids:
        s = s.where(F.col("retailer_id").isin(*cfg.retailer_ids))
    if cfg.store_ids:
        s = s.where(F.col("store_id").isin(*cfg.store_ids))
    if cfg.exclude_store_ids:
        s = s.where(~F.col("store_id").isin(*cfg.exclude_store_ids))
    for column, values in (("payment_method_id", cfg.payment_methods), ("tenant_id", cfg.tenant_ids), ("platform", cfg.platforms)):
        if values:
            s = s.where(F.col(column).isin(*values))
    if cfg.states:  # a job without a state filter takes every state
        s = s.where(F.col("shipment_state").isin(*cfg.states))
    return s


def _scoped(src: Sources, cfg: PulseConfig) -> DataFrame:
    """Shipments of the scope, those of its stores' zones too (P5 nested in J4).
    A store without a zone is in none, whether zones are listed or excluded."""
    s = _scope(src.shipments, cfg)
    if not (cfg.zones or cfg.exclude_zones):
        return s
    stores = src.stores.where(F.col("zone").isNotNull())
    if cfg.zones:
        stores = stores.where(F.col("zone").isin(*cfg.zones))
    if cfg.exclude_zones:
        stores = stores.where(~F.col("zone").isin(*cfg.exclude_zones))
    return joins.semi(s, stores.select("store_id"), "store_id")


def candidates(src: Sources, cfg: PulseConfig, as_of: str = AS_OF) -> DataFrame:
    """Shipments of the scope inside the look-back window, with slot,
    company and local times. Slot dates are compared as dates with the
    as-of date minus N days, inclusive."""
    s = _scoped(src, cfg)
    w = src.windows.select(F.col("id").alias("shipment_id"), F.col("starts_at").alias("slot_start"),
                           F.col("ends_at").alias("slot_end"))
    s = s.join(w, "shipment_id", "inner")
    asof = tf.ts_lit(as_of)
    if cfg.window_basis == "slot":
        first_day = F.date_sub(F.to_date(asof), cfg.window_days)
        # A coarse bound on the raw UTC time reaches the scan (a zone offset is
        # less than a day); the exact local-date test follows.
        s = s.where(F.col("slot_start") >= F.date_sub(first_day, 1).cast("timestamp_ntz"))
        s = s.where(tf.local_date("slot_start") >= first_day)
    elif cfg.window_basis == "completed_date":
        first_day = F.date_sub(F.to_date(asof), cfg.window_days)
        s = s.where(F.col("completed_at") >= F.date_sub(first_day, 1).cast("timestamp_ntz"))
        s = s.where(tf.local_date("completed_at") >= first_day)
    else:
        s = s.where(tf.lookback("completed_at", asof, f"{cfg.window_days} days"))
    s = s.join(src.company_orders, "order_id", "inner")
    return s.withColumn("completed_local", tf.local_ts("completed_at")).withColumn(
        "slot_end_local", tf.local_ts("slot_end"))


def not_sent(df: DataFrame, ledger: DataFrame, cfg: PulseConfig) -> DataFrame:
    """Candidates not yet in this pulse's ledger(s). The ledger is partitioned
    by process, so only this pulse's rows are read."""
    names = list(cfg.ledger_names or (cfg.process_name,))
    sent = ledger.where(F.col("process_name").isin(*names)).select("shipment_number")
    return joins.anti(df, sent, "shipment_number")


def _enrich(df: DataFrame, src: Sources, cfg: PulseConfig) -> DataFrame:
    """Live line items of the shipment (joined by shipment, not by order),
    catalogue (inner) and manager contacts (left, then the fallbacks)."""
    key = cfg.lines_by
    li = src.line_items.where(F.col("deleted_at").isNull()).select(key, "offer_id", "quantity", "price")
    o = src.offers.select(F.col("id").alias("offer_id"), F.col("name").alias("offer_name"))
    d = src.directory.select("company_id", "manager_email", "manager_phones", "manager_name")
    j = df.join(li, key, "inner").join(o, "offer_id", "inner").join(d, "company_id", "left")
    fb = cfg.fallback
    return rules.fill_defaults(j, {"manager_email": fb.email, "manager_phones": fb.phone, "manager_name": fb.name})


REPORT_COLS = ["completed_local", "slot_end_local", "shipment_number", "quantity", "price", "offer_name",
               "manager_email", "manager_phones", "manager_name"]


def enrich_report(shipments: DataFrame, src: Sources, cfg: PulseConfig) -> DataFrame:
    """Report rows of the given (unreported) candidate shipments."""
    return _enrich(shipments, src, cfg).select(*REPORT_COLS).distinct()


def new_orders(src: Sources, cfg: PulseConfig, as_of: str = AS_OF) -> DataFrame:
    """K2: rows of shipments not yet reported by this pulse."""
    return enrich_report(not_sent(candidates(src, cfg, as_of), src.ledger, cfg), src, cfg)


def new_orders_feeds(src: Sources, cfgs: list[PulseConfig], as_of: str = AS_OF) -> DataFrame:
    """K2 with several feeds (e.g. one store, plus two retailers minus that
    store) sharing one ledger: each feed is checked against every feed's
    ledger, so a shipment is reported once whichever feed finds it."""
    names = tuple(dict.fromkeys(n for c in cfgs for n in (c.ledger_names or (c.process_name,))))
    out = None
    for c in cfgs:
        rows = new_orders(src, replace(c, ledger_names=names), as_of).withColumn("feed", F.lit(c.process_name))
        out = rows if out is None else out.unionByName(rows)
    return out


def ledger_rows(report: DataFrame, cfg: PulseConfig, as_of: str = AS_OF) -> DataFrame:
    """Distinct reported shipments, stamped with the process and time."""
    return (report.select("shipment_number").distinct()
            .withColumn("process_name", F.lit(cfg.process_name))
            .withColumn("shipment_logged_at", tf.ts_lit(as_of)))


def payable(df: DataFrame, src: Sources, cfg: PulseConfig) -> DataFrame:
    """P15 for candidates that carry ``company_id``: no locked order, and paid,
    a deferred method, a small balance gap or a postpay company. The gap (W3)
    is that of the whole order: all shipments of the candidates' balance-due
    orders, wherever they go. ``cfg.gate`` leaves the balance out
    ("pay_no_balance"), or only asks that the payment did not fail or the company
    pays later, locked or not ("state")."""
    postpay = src.directory.where(F.col("con_flag") == "postpay").select("company_id").distinct().withColumn("_postpay", F.lit(True))
    if cfg.gate == "state":
        df = df.join(postpay, "company_id", "left")
        return df.where(rules.state_gate("payment_state") | F.coalesce("_postpay", F.lit(False))).drop("_postpay")
    locked = src.locked.where(F.col("export_lock_state") == "locked").select("order_id")
    df = joins.anti(df, locked, "order_id")
    balance_ok = F.lit(False)
    if cfg.gate == "pay":
        due = df.where(F.col("payment_state") == "balance_due").select("order_id").distinct()
        gaps = windows.balance_due_window(joins.semi(src.shipments, due, "order_id"), "order_id", "payment_total", "total")
        df = df.join(gaps.withColumn("_bal_ok", F.lit(True)), "order_id", "left")
        balance_ok = F.col("_bal_ok")
    df = df.join(postpay, "company_id", "left")
    gate = rules.pay_gate("payment_state", "payment_method_id", balance_ok) | F.coalesce("_postpay", F.lit(False))
    return df.where(F.coalesce(gate, F.lit(False))).drop("_bal_ok", "_postpay")


def next_day_candidates(src: Sources, cfg: PulseConfig, as_of: str) -> DataFrame:
    """Shipments of the scope with a slot on the next business day, with slot and
    company. The range on the stored time reaches the scan; with ``slot_day``
    "local" it is a day wider on both sides and the exact day in the zone follows."""
    if cfg.slot_day not in ("utc", "local"):
        raise ValueError(f"slot_day is 'utc' or 'local', not {cfg.slot_day!r}")
    day = tf.next_business_day(tf.ts_lit(as_of))
    around = int(cfg.slot_day == "local")
    w = src.windows.select(F.col("id").alias("shipment_id"), F.col("starts_at").alias("slot_start"))
    w = w.where((F.col("slot_start") >= F.date_sub(day, around).cast("timestamp_ntz"))
                & (F.col("slot_start") < F.date_add(day, 1 + around).cast("timestamp_ntz")))
    if around:
        w = w.where(tf.local_date("slot_start") == day)
    return _scoped(src, cfg).join(w, "shipment_id").join(src.company_orders, "order_id", "left")


def _next_day_base(src: Sources, cfg: PulseConfig, as_of: str) -> DataFrame:
    """The next business day's candidates that are ``payable``. They are a day's
    slots out of the whole history and are used for the orders that owe, for those
    orders' gaps and for the result: written once, read from there."""
    s = next_day_candidates(src, cfg, as_of)
    return payable(cut_lineage(s, "next-day") if cfg.gate == "pay" else s, src, cfg)


def next_day(src: Sources, cfg: PulseConfig, as_of: str = AS_OF) -> DataFrame:
    """K3: picking list for the next business day's slots."""
    s = _next_day_base(src, cfg, as_of)
    li = src.line_items.where(F.col("deleted_at").isNull()).select("shipment_id", "offer_id", "quantity")
    o = src.offers.select(F.col("id").alias("offer_id"), F.col("name").alias("offer_name"))
    out = s.join(li, "shipment_id").join(o, "offer_id")
    return out.select("shipment_number", tf.local_ts("completed_at").alias("completed_local"),
                      tf.local_ts("slot_start").alias("slot_start_local"), "offer_name", "quantity",
                      "payment_method_name", "total_weight").distinct()


def consignees(src: Sources, cfg: PulseConfig, companies: DataFrame, as_of: str = AS_OF,
               min_qty: float = 240, categories: tuple[str, ...] = ("%paper%",),
               special_store: int | None = None, category_ids: tuple[int, ...] = (),
               clients: DataFrame | None = None) -> DataFrame:
    """K3: consignee list for paper documents. Next-day shipments (same gate)
    with a line of at least ``min_qty`` units of an offer in the listed
    categories, by id where ``category_ids`` are given, else by pattern, with the
    company's tax id and name; rows of ``special_store`` go to their own file (T7
    route, column ``route``). ``cfg.lines_by`` says whether the shipment's or the
    whole order's lines count. With ``clients`` (a row per user) the list has the
    contact's name and mail, the pending one first."""
    from martlet.operators.reshape import route

    s = _next_day_base(src, cfg, as_of)
    li = (src.line_items.where(F.col("deleted_at").isNull() & (F.col("quantity") >= min_qty))
          .select(cfg.lines_by, "offer_id", "quantity"))
    listed = F.col("category_id").isin(*category_ids) if category_ids else rules.like_any("category", categories, fold_case=True)
    o = src.offers.where(listed).select(F.col("id").alias("offer_id"), F.col("name").alias("offer_name"))
    c = companies.select("company_id", "inn", F.col("name").alias("company_name"), *_if_there(companies, "kpp"))
    rows = s.join(li, cfg.lines_by).join(o, "offer_id").join(c, "company_id", "inner")
    contact: list[str] = []
    if clients is not None:
        rows, contact = _with_contact(rows, clients)
    rows = rows.select("inn", *_if_there(companies, "kpp"), "company_name", "shipment_number", *contact, "offer_name",
                       "quantity", "store_id").distinct()
    special, other = route(rows, F.col("store_id") == F.lit(special_store))
    return (special.withColumn("route", F.lit("special_store"))
            .unionByName(other.withColumn("route", F.lit("other"))).drop("store_id"))


def _if_there(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def _with_contact(rows: DataFrame, clients: DataFrame) -> tuple[DataFrame, list[str]]:
    """The ordering user's full name and mail (left: an unknown user has neither)."""
    c = clients.select("user_id", full_name("firstname", "lastname").alias("contact_name"),
                       F.coalesce("pending_email", "email").alias("contact_email"))
    return rows.join(c, "user_id", "left"), ["contact_name", "contact_email"]


def promo_consignees(src: Sources, cfg: PulseConfig, order_promos: DataFrame, companies: DataFrame,
                     clients: DataFrame, codes: tuple[str, ...], as_of: str = AS_OF) -> DataFrame:
    """K3: consignees of the next business day's ``payable`` shipments whose order
    used one of the promo ``codes`` (given for large orders with paper documents),
    without regard to lines. ``order_promos`` holds (order_id, promo_code), any
    number per order; a code is compared as written."""
    coded = order_promos.where(F.col("promo_code").isin(*codes)).select("order_id")
    s = joins.semi(_next_day_base(src, cfg, as_of), coded, "order_id")
    c = companies.select("company_id", "inn", F.col("name").alias("company_name"), *_if_there(companies, "kpp"))
    rows, contact = _with_contact(s.join(c, "company_id", "inner"), clients)
    return rows.select("inn", *_if_there(companies, "kpp"), "company_name", "shipment_number", *contact).distinct()


def big_orders(src: Sources, cfg: PulseConfig, as_of: str = AS_OF) -> DataFrame:
    """K4: lines of unreported shipments over the thresholds (``and``: line
    and shipment both; ``or``: either), of ``payable`` orders."""
    mode, line_min, total_min = cfg.line_rule
    c = payable(not_sent(candidates(src, cfg, as_of), src.ledger, cfg), src, cfg)
    li = src.line_items.where(F.col("deleted_at").isNull()).select("shipment_id", "offer_id", "price", "quantity")
    j = c.join(li, "shipment_id").withColumn("sku_total", F.col("price") * F.col("quantity"))
    j = j.where(rules.big_order("sku_total", "total", line_min, total_min, mode))
    return j.select("shipment_number", "company_id", "store_id", "offer_id", "price", "quantity", "sku_total",
                    "total", "completed_local")


def store_keys(store_configs: DataFrame) -> DataFrame:
    """A store's key number is the part of its import key after the
    first '-' (at most 15 characters), kept as text."""
    from martlet.functions.text import key_from_text

    return store_configs.select("store_id", key_from_text("import_key").alias("key_number")).distinct()


def recipients(rows: DataFrame, directory: DataFrame, store_config: DataFrame, directors: DataFrame,
               fb: Fallback = Fallback()) -> DataFrame:
    """K4 + S10: who receives each alerted shipment: the responsible managers
    of its company (fallback mail when none), and the director and deputy of
    its store found through the store key number; mails lower-cased, sorted,
    distinct. A shipment has a handful of recipients, so the per-shipment set
    is bounded."""
    ship = rows.select("shipment_number", "company_id", "store_id").distinct()
    mgr = (ship.join(directory.select("company_id", "manager_email"), "company_id", "left")
           .select("shipment_number", F.coalesce("manager_email", F.lit(fb.email)).alias("mail")))
    keyed = ship.join(store_keys(store_config), "store_id", "inner").join(directors, "key_number", "inner")
    store = keyed.select("shipment_number", F.explode(F.array("director_email", "zamdirector_email")).alias("mail"))
    mails = mgr.unionByName(store).where(F.col("mail").isNotNull()).select("shipment_number", F.lower("mail").alias("mail"))
    g = mails.groupBy("shipment_number").agg(F.array_sort(F.collect_set("mail")).alias("recipients"))
    return g.withColumn("recipients_text", F.array_join("recipients", "; "))


def _over_limit_lines(gated: DataFrame, src: Sources) -> DataFrame:
    li = src.line_items.where(F.col("deleted_at").isNull()).select("shipment_id", "offer_id", "quantity")
    o = src.offers.select(F.col("id").alias("offer_id"), "retailer_sku")
    lim = src.limits.dropna(subset=["max_qty"])
    j = gated.join(li, "shipment_id").join(o, "offer_id").join(lim, "retailer_sku")
    return j.where(F.col("quantity") > F.col("max_qty"))


def over_limit_ledgers(src: Sources, cfg: PulseConfig, as_of: str = AS_OF,
                       log_before_gate: bool = False) -> DataFrame:
    """K5 two-stage ledger: shipments not yet *scanned* are checked; the
    scanned stage is logged after the payment gate (so an unpaid shipment is
    checked again on the next run), or before it with ``log_before_gate``
    (the reference's order, where such a shipment is never re-checked); the
    *alerted* stage logs the shipments with a line over its limit."""
    scan_name = cfg.scan_ledger or f"{cfg.process_name}_scanned"
    scan_cfg = replace(cfg, process_name=scan_name, ledger_names=())
    fresh = not_sent(candidates(src, scan_cfg, as_of), src.ledger, scan_cfg)
    gated = payable(fresh, src, cfg)
    scanned = (fresh if log_before_gate else gated).select("shipment_number").distinct()
    alerted = _over_limit_lines(gated, src).select("shipment_number").distinct()
    stamp = tf.ts_lit(as_of)
    return (scanned.withColumn("process_name", F.lit(scan_name))
            .unionByName(alerted.withColumn("process_name", F.lit(cfg.process_name)))
            .withColumn("shipment_logged_at", stamp))


def over_limit(src: Sources, cfg: PulseConfig, as_of: str = AS_OF) -> DataFrame:
    """K5: unreported lines whose quantity is above the SKU's limit (strict).
    The gate is evaluated before anything is logged, so a line that is not
    yet paid is looked at again on the next run."""
    c = payable(not_sent(candidates(src, cfg, as_of), src.ledger, cfg), src, cfg)
    return _over_limit_lines(c, src).select("shipment_number", "retailer_sku", "quantity", "max_qty", "completed_local")


def over_limit_contacts(src: Sources, cfg: PulseConfig, stores: DataFrame, contacts: DataFrame,
                        as_of: str = AS_OF) -> DataFrame:
    """K5 with the contact of each line's store, found through the store's key
    number; a line whose store has no contact stays, without one (left join)."""
    c = payable(not_sent(candidates(src, cfg, as_of), src.ledger, cfg), src, cfg)
    rows = _over_limit_lines(c, src).select("shipment_number", "store_id", "retailer_sku", "quantity", "max_qty")
    return (rows.join(store_keys(stores), "store_id", "left").join(contacts, "key_number", "left")
            .select("shipment_number", "store_id", "retailer_sku", "quantity", "max_qty", "contact").distinct())


def hourly(src: Sources, cfg: PulseConfig, as_of: str = AS_OF) -> DataFrame:
    """K6: shipments completed (or canceled) since the hourly look-back start
    (49 h on Monday just after midnight), no ledger."""
    asof = tf.ts_lit(as_of)
    s = _scoped(src, cfg)
    s = s.where((F.col("completed_at") > tf.hourly_lookback(asof)) & (F.col("completed_at") <= asof))
    s = s.join(src.company_orders, "order_id", "left")
    s = s.withColumn("completed_local", tf.local_ts("completed_at"))
    li = src.line_items.where(F.col("deleted_at").isNull()).select("shipment_id", "offer_id", "quantity", "price")
    o = src.offers.select(F.col("id").alias("offer_id"), F.col("name").alias("offer_name"))
    d = src.directory.select("company_id", "manager_email", "manager_name")
    j = s.join(li, "shipment_id").join(o, "offer_id").join(d, "company_id", "left")
    j = rules.fill_defaults(j, {"manager_email": cfg.fallback.email, "manager_name": cfg.fallback.name})
    return j.select("shipment_number", "shipment_state", "completed_local", "offer_name", "quantity", "price",
                    "manager_email", "manager_name").distinct()
