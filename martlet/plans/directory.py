"""K11 responsible-manager directory and K12 offer catalogue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.text import full_name
from martlet.operators import aggs


@dataclass(frozen=True)
class Fallback:
    """Contacts used when a company has no responsible manager. Real values
    are deployment configuration; these are placeholders."""

    email: str = "support@example.org"
    phone: str = "78000000000"
    name: str = "B2B support team"


def manager_directory(company: DataFrame, company_manager: DataFrame, users: DataFrame,
                      phones: DataFrame, fb: Fallback = Fallback()) -> DataFrame:
    """One row per company and responsible manager (every company kept):
    manager mail and name with fallbacks, the manager's phones as sorted
    distinct text (an empty phone becomes the fallback phone), and the
    contract flag ('postpay' for postpay or deposit companies). A company table
    with a ``kpp`` passes it on."""
    cm = (company_manager.where(F.col("deleted_at").isNull()).select("company_id", "user_id")
          .join(users.select(F.col("id").alias("user_id"), full_name("firstname", "lastname").alias("user_fio"),
                             F.col("email").alias("user_email")), "user_id", "inner")
          .distinct())
    ph = phones.select("user_id", F.col("value").alias("phone"))
    tax = ["inn", "kpp"] if "kpp" in company.columns else ["inn"]
    c = company.select("company_id", *tax, "name",
                       F.when(F.col("postpay_flg") | F.col("deposit_flg"), "postpay").otherwise("another").alias("con_flag"))
    j = c.join(cm, "company_id", "left").join(ph, "user_id", "left")
    phone = F.when(F.col("phone") == "", F.lit(fb.phone)).otherwise(F.col("phone"))
    return (j.groupBy("company_id", *tax, "name",
                      F.coalesce("user_email", F.lit(fb.email)).alias("manager_email"),
                      F.coalesce("user_fio", F.lit(fb.name)).alias("manager_name"), "con_flag")
            .agg(F.array_join(F.array_sort(F.collect_set(phone)), ", ").alias("manager_phones")))


def manager_mails(company_manager: DataFrame, users: DataFrame, fb: Fallback = Fallback()) -> DataFrame:
    """K11, mail only: the mails of each company's responsible managers, the
    fallback mail for a manager who is unknown or has none. Companies without a
    manager are not listed; managers with equal mails are one row."""
    u = users.select(F.col("id").alias("user_id"), F.col("email").alias("user_email"))
    live = company_manager.where(F.col("deleted_at").isNull()).select("company_id", "user_id")
    return (live.join(u, "user_id", "left")
            .select("company_id", F.coalesce("user_email", F.lit(fb.email)).alias("manager_email")).distinct())


def offer_catalogue(offers: DataFrame, prices: DataFrame) -> DataFrame:
    """Active offers with their latest price (NULL prices skipped) and category."""
    latest = prices.groupBy("offer_id").agg(aggs.arg_max("price", "dt").alias("last_price"),
                                            F.max("dt").alias("price_dt"))
    active = offers.where(F.col("deleted_at").isNull() & (F.col("published") == 1) & (F.col("status") == 1))
    return (active.select(F.col("id").alias("offer_id"), "name", "retailer_sku", "category")
            .join(latest, "offer_id", "left"))
