"""The marts. Each builder reads its sources by role; ``as_of`` stands for today.

Wide joins are arranged by key: dimensions that hang on the same user are joined to each other first, so a fact is
shuffled once per key instead of once per dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cases import bucket, case_when, flag, null_if, signed_amount
from ledgerloom.functions.dates import back, datetime_of, month_start, months_apart
from ledgerloom.functions.jsonpath import field_value, json_scalar, with_json_strings
from ledgerloom.functions.text import page_url
from ledgerloom.operators.filters import recent, without_unnamed
from ledgerloom.operators.incremental import dim_diff, edge_diff, read_final
from ledgerloom.operators.joins import anti_before_first, spread_join
from ledgerloom.operators.messages import keyword_flag
from ledgerloom.operators.windows import latest_per_key, net_equals
from ledgerloom.plans.registry import Context, model, slice_of

# The class labels, bounds and codes below are part of the marts' results.
KEYWORDS = ("seller", "idr", "price", "contact")
STORE_GATEWAYS = ("appstore", "google_play")
AGENCY_GATEWAYS = ("gw.bank_transfer", "gw.internal.tether", "gw.internal.bank_transfer.vn")
DIRECT_PRODUCTS = ("stripe", "donation_direct")
MONETARY_BOUNDS = (1.0, 2.0, 5.0, 10.0)
MONETARY = ("N01. one_timer", "N02. micro_user", "N03. light_user", "N04. casual_user", "N05. power_user", "N06. whale_user")
FREQUENCY_BOUNDS = (3, 7, 10)
FREQUENCY = (
    "N01. tester",
    "N02. one_timer",
    "N03. occational_user",
    "N04. engaged_user",
    "N05. regular_user",
    "N06. enthusiastic_user",
)
TESTER_USD = 0.5
BAND_BOUNDS = (0.5, 1.0, 3.0, 5.0, 10.0)
BANDS = (
    "N01. 0.00 - 0.50 usd",
    "N02. 0.51 - 1.00 usd",
    "N03. 1.01 - 3.00 usd",
    "N04. 3.01 - 5.00 usd",
    "N05. 5.01 - 10.00 usd",
    "N06. > 10.00 usd",
)
PUSH_PROPERTIES = {
    "os": "$os",
    "utm_campaign": "utm_campaign",
    "browser": "$browser",
    "country_name": "$geoip_country_name",
    "ip": "$ip",
    "distinct_id_properties": "distinct_id",
    "browser_version": "$browser_version",
    "device": "$device",
    "os_version": "$os_version",
    "raw_user_agent": "$raw_user_agent",
    "session_id": "$session_id",
    "browser_language": "$browser_language",
}


def user_alias(user: DataFrame) -> Column:
    return F.coalesce(user["alias"].cast("string"), user["prev_alias"])


def product_slugs(ctx: Context, payments: DataFrame) -> DataFrame:
    """Payments with the slug of the bought package, found by the product id in the gateway's answer."""
    product = field_value(payments, "gateway_response", "$.productId")
    keyed = payments.withColumn("_product", F.replace(product, F.lit(str(ctx.var("product_prefix", ""))), F.lit("")))
    packages = ctx.source("conversion_package").select(F.col("id").cast("string").alias("_product"), "slug")
    return keyed.join(packages, "_product", "left").drop("_product", "gateway_response")


def topup_class(ctx: Context, user: Column, gateway: Column, quantity: Column, kind: Column | None = None) -> Column:
    """How stars were bought. ``_`` in the account pattern stands for any character."""
    internal = user.like(str(ctx.var("internal_account", "internal_%")))
    branches = [
        (internal, F.lit("internal_deposit")),
        (gateway.isin(*STORE_GATEWAYS), F.lit("iap")),
        (gateway.isin(*AGENCY_GATEWAYS) & ~internal & quantity.isNotNull(), F.lit("for_agency")),
    ]
    if kind is not None:
        branches.append((kind == "transfer_inbound", F.lit("transfer_inbound")))
    return case_when(branches, F.lit("others"))


def user_profiles(ctx: Context, role: str) -> DataFrame:
    """Users with channel page, country name and transfer permission, columns named after the role.

    A user with several channels has several rows.
    """
    user = ctx.source("user_account")
    channel = ctx.source("channel").select(F.col("owner_id").alias("id"), "slug")
    country = ctx.source("country").select(F.col("alpha_2").alias("country"), F.col("name").alias("country_name"))
    allowed = ctx.source("transfer_permission").select(F.col("user_id").alias("id"), "is_allowed")
    base = user.select(
        "id",
        "username",
        user_alias(user).alias("alias_text"),
        F.coalesce(user["alias"], user["prev_alias"].try_cast("long")).alias("alias"),
        "display_name",
        "country",
    )
    wide = base.join(channel, "id", "left").join(allowed, "id", "left").join(country, "country", "left")
    return wide.select(
        F.col("username").alias(f"{role}_username"),
        F.col("alias_text").alias(f"{role}_alias_text"),
        F.col("id").alias(f"{role}_id"),
        F.col("alias").alias(f"{role}_alias"),
        F.col("display_name").alias(f"{role}_display_name"),
        page_url(str(ctx.var("page_base", "")), F.col("slug")).alias(f"{role}_page"),
        F.col("country").alias(f"{role}_country"),
        F.col("country_name").alias(f"{role}_country_name"),
        F.col("is_allowed").alias(f"{role}_allowed"),
    )


@model("star_purchase", "ledger/star_purchase", partition_by=("purchase_at", "DAY"))
def star_purchase(ctx: Context) -> DataFrame:
    """One row per top-up or inbound transfer and payment, with both parties' profiles and refund flags."""
    ledger = (
        ctx.source("billing_ledger")
        .where(F.col("type").isin("top_up", "transfer_inbound"))
        .select(
            F.col("id").alias("billing_transaction_id"),
            "created_at",
            F.col("user_id").alias("buyer_username"),
            json_scalar(F.col("metadata"), "$.sender_alias").alias("seller_alias_text"),
            F.col("paymee_order_id").alias("checkout_key"),
            "type",
            F.col("amount").alias("ledger_amount"),
        )
    )
    keywords = keyword_flag(ctx.source("post"), "owner_id", "text", ctx.var("keywords", KEYWORDS), "has_keyword")
    sellers = user_profiles(ctx, "seller").drop("seller_username")
    sellers = sellers.join(keywords.withColumnRenamed("owner_id", "seller_id"), "seller_id", "left")
    buyers = user_profiles(ctx, "buyer").drop("buyer_alias_text")

    checkouts = ctx.source("checkout").select(
        F.col("id").alias("checkout_key"),
        F.col("id").cast("string").alias("checkout_id"),
        F.col("user_id").alias("checkout_user"),
        "top_up_quantity",
        json_scalar(F.col("lines"), "$[0].conversion_package_slug").alias("line_slug"),
    )
    paid = ctx.source("payment")
    mark = F.xxhash64("gateway", "charge_status", "amount", "updated_at").alias("_payment")
    payments = product_slugs(ctx, paid).select(
        F.col("checkout_id").alias("checkout_key"), "gateway", "charge_status", "slug", mark
    )
    # The refund flag belongs to the checkout, so it is taken from the payments before they fan out. Ledger rows
    # without a checkout have no payment and get false; they never gather in one window partition.
    refunded = paid.where("charge_status = 'REFUNDED'").select(F.col("checkout_id").alias("checkout_key")).distinct()
    checkouts = checkouts.join(refunded.withColumn("refunded", F.lit(True)), "checkout_key", "left")

    facts = ledger.join(checkouts, "checkout_key", "left")
    facts = facts.withColumn("checkout_key", F.when(F.col("checkout_id").isNotNull(), F.col("checkout_key")))
    facts = spread_join(
        facts,
        payments,
        "checkout_key",
        "left",
        hot="right",
        count_right=paid.select(F.col("checkout_id").alias("checkout_key"), mark),
        spread_right_by=["_payment"],
    )
    facts = facts.join(buyers, "buyer_username", "left").join(sellers, "seller_alias_text", "left")

    top_up = F.col("type") == "top_up"
    final = facts.select(
        F.to_date("created_at").alias("purchase_at"),
        datetime_of(F.col("created_at")).alias("purchase_time"),
        "buyer_id",
        "buyer_alias",
        "buyer_display_name",
        "buyer_page",
        "buyer_country",
        "buyer_country_name",
        "seller_id",
        "seller_alias",
        "seller_display_name",
        "seller_page",
        null_if(top_up, F.col("seller_country")).alias("seller_country"),
        null_if(top_up, F.col("seller_country_name")).alias("seller_country_name"),
        flag(F.col("buyer_allowed")).alias("buyer_is_allowed_transfer"),
        flag(F.col("seller_allowed")).alias("seller_is_allowed_transfer"),
        "gateway",
        topup_class(ctx, F.col("checkout_user"), F.col("gateway"), F.col("top_up_quantity"), F.col("type")).alias(
            "topup_type"
        ),
        "billing_transaction_id",
        "checkout_id",
        F.coalesce("line_slug", "slug").alias("topup_star_package"),
        "charge_status",
        signed_amount(F.col("ledger_amount"), F.col("charge_status") == "REFUNDED").alias("amount"),
        flag(F.col("refunded")).alias("is_refunded"),
        "type",
        flag(F.col("has_keyword") & F.col("seller_allowed")).alias("is_keyword_contains"),
    )
    return without_unnamed(final, "type", "transfer_inbound", "seller_alias")


@model("user_topup_transaction", "ledger_inline/user_topup_transaction")
def user_topup_transaction(ctx: Context) -> DataFrame:
    """Completed star checkouts, paid or refunded, not for testing, whose payments net to exactly one."""
    checkouts = ctx.source("checkout").where(
        (F.col("status") == "COMPLETED") & (F.col("type") == "star") & ~flag(F.col("is_test_purchase"))
    )
    users = ctx.source("user_account").select(F.col("id").alias("account_id"), F.col("username").alias("user_id"), "country")
    charged = ctx.source("payment").where(F.col("charge_status").isin("CHARGED", "REFUNDED"))
    # The window of the net count lies inside one checkout, so it may run before the checkouts are picked.
    paid = net_equals(charged, "checkout_id", F.col("charge_status") == "REFUNDED", 1)
    paid = product_slugs(ctx, paid).select(
        F.col("checkout_id").alias("key"), "gateway", F.col("amount").alias("paid_amount"), "updated_at", "slug"
    )
    details = checkouts.select(
        F.col("id").alias("key"),
        "user_id",
        "top_up_quantity",
        json_scalar(F.col("lines"), "$[0].conversion_package_slug").alias("line_slug"),
    )
    rows = paid.join(details, "key", "inner").join(users, "user_id", "left")
    quantity = F.col("top_up_quantity")
    return rows.select(
        F.col("account_id").alias("user_id"),
        "country",
        F.col("key").cast("string").alias("id"),
        F.lit(None).cast("bigint").alias("seller_id"),
        datetime_of(F.col("updated_at")).alias("first_purchase_at"),
        F.when(F.coalesce(quantity, F.lit(0)) == 0, F.col("paid_amount").cast("double") * 100)
        .otherwise(quantity)
        .cast("double")
        .alias("amount"),
        F.coalesce("line_slug", "slug").alias("star_package"),
        topup_class(ctx, F.col("user_id"), F.col("gateway"), quantity).alias("type"),
    )


@model("monthly_pay_user", "ledger/monthly_pay_user", after=("star_purchase", "user_topup_transaction"))
def monthly_pay_user(ctx: Context) -> DataFrame:
    """Payer ledger: top-ups, inbound transfers and direct payments per day, user and transaction, in USD."""
    purchases = ctx.ref("star_purchase").where("type = 'transfer_inbound'")
    firsts = purchases.groupBy("seller_id").agg(F.min("purchase_at").alias("first_sell"))
    buying = purchases.where(F.col("buyer_id").isNotNull())
    inbound = anti_before_first(buying, firsts, "buyer_id", "seller_id", "purchase_at", "first_sell")

    account = F.col("user_id").like(str(ctx.var("internal_user", "internal%")))
    external = ctx.source("billing_ledger").where(~account)
    external = external.select(F.col("paymee_order_id").cast("string").alias("id"), F.col("id").alias("ledger_id"))
    # The pattern test drops top-ups without a ledger row, so the join is an inner one.
    topups = ctx.ref("user_topup_transaction").join(external, "id", "inner")
    direct = ctx.source("direct_event").where(F.col("product_type").isin(*DIRECT_PRODUCTS))

    cents = F.sum(F.col("amount").cast("decimal(28,4)")).cast("double") / 100
    branches = [
        topups.groupBy(
            F.to_date("first_purchase_at").alias("date_key"),
            "user_id",
            F.lit("topup").alias("type"),
            F.col("star_package").alias("subtype"),
            F.col("ledger_id").cast("string").alias("transaction_id"),
        ).agg(cents.alias("usd_amount")),
        inbound.groupBy(
            F.col("purchase_at").alias("date_key"),
            F.col("buyer_id").alias("user_id"),
            F.lit("transfer_inbound").alias("type"),
            F.lit("transfer_inbound").alias("subtype"),
            F.col("billing_transaction_id").cast("string").alias("transaction_id"),
        ).agg(cents.alias("usd_amount")),
        direct.groupBy(
            F.col("transaction_date").alias("date_key"),
            "user_id",
            F.when(F.col("product_type") == "stripe", "membership_direct").otherwise(F.col("product_type")).alias("type"),
            F.col("product_type").alias("subtype"),
            F.col("consum_transaction_id").cast("string").alias("transaction_id"),
        ).agg(F.sum(F.col("usd_amount").cast("decimal(28,4)")).cast("double").alias("usd_amount")),
    ]
    first, second, third = branches
    return first.unionByName(second).unionByName(third)


def monetary_rank(usd: Column, count: Column, scale: float = 1.0) -> Column:
    """Money tier 1 to 6, 0 for an unknown amount. ``scale`` multiplies all bounds."""
    branches = [((count == 1) & (usd <= TESTER_USD * scale), F.lit(1))]
    branches += [(usd <= bound * scale, F.lit(rank)) for rank, bound in enumerate(MONETARY_BOUNDS, 2)]
    return case_when([*branches, (usd > MONETARY_BOUNDS[-1] * scale, F.lit(6))], F.lit(0))


def frequency_rank(usd: Column, count: Column, scale: float = 1.0) -> Column:
    """Frequency tier 1 to 6, 0 for an unknown count."""
    branches = [((count == 1) & (usd <= TESTER_USD * scale), F.lit(1)), (count == 1, F.lit(2))]
    branches += [(count <= bound, F.lit(rank)) for rank, bound in enumerate(FREQUENCY_BOUNDS, 3)]
    return case_when([*branches, (count > FREQUENCY_BOUNDS[-1], F.lit(6))], F.lit(0))


def tier_label(rank: Column, labels: tuple[str, ...]) -> Column:
    return F.when(rank.isNotNull(), F.coalesce(F.get(F.array(*[F.lit(x) for x in labels]), rank - 1), F.lit("others")))


@model("monthly_segmentation", "ledger/monthly_segmentation", after=("monthly_pay_user",))
def monthly_segmentation(ctx: Context) -> DataFrame:
    """Money and frequency tiers per user and month.

    The months joined back to the ledger rows they were summed from give each month once, except that an equi-join
    finds nothing for a NULL user or date: those keep their row with empty measures. So no join is needed.
    """
    scale = float(ctx.var("tier_scale", 1.0))
    months = (
        ctx.ref("monthly_pay_user")
        .groupBy(month_start(F.col("date_key")).alias("date_key"), "user_id")
        .agg(
            F.sum(F.col("usd_amount").cast("decimal(28,6)")).cast("double").alias("usd"),
            F.countDistinct("transaction_id").alias("n"),
        )
    )
    known = F.col("user_id").isNotNull() & F.col("date_key").isNotNull()
    ranked = months.select(
        "date_key",
        "user_id",
        F.when(known, F.col("usd")).alias("monthly_usd_amount"),
        F.when(known, F.col("n")).alias("monthly_transaction_count"),
        F.when(known, monetary_rank(F.col("usd"), F.col("n"), scale)).alias("monthly_monetary_rank"),
        F.when(known, frequency_rank(F.col("usd"), F.col("n"), scale)).alias("monthly_frequency_rank"),
    )
    return ranked.select(
        "date_key",
        "user_id",
        "monthly_usd_amount",
        "monthly_transaction_count",
        tier_label(F.col("monthly_monetary_rank"), MONETARY).alias("monthly_monetary_type"),
        "monthly_monetary_rank",
        tier_label(F.col("monthly_frequency_rank"), FREQUENCY).alias("monthly_frequency_type"),
        "monthly_frequency_rank",
    )


@model("pay_user_flagging", "ledger/pay_user_flagging", after=("monthly_segmentation",))
def pay_user_flagging(ctx: Context) -> DataFrame:
    """Active or retired payers with their best tiers of the last months and their tiers when last active.

    Newest month and recent maxima come out of one aggregation, so the segmentation is read and shuffled once.
    """
    since = back(ctx.as_of, 2, "whole_months")
    measures = ["monthly_monetary_type", "monthly_monetary_rank", "monthly_frequency_type", "monthly_frequency_rank"]
    in_window = F.col("date_key") >= since
    users = (
        ctx.ref("monthly_segmentation")
        .groupBy("user_id")
        .agg(
            F.max(F.struct("date_key", *measures)).alias("last"),
            *[F.max(F.when(in_window, F.col(m))).alias(f"best_{m}") for m in measures],
        )
    )
    # An equi-join on the user finds no recent months for a NULL user.
    best = {m: F.when(F.col("user_id").isNotNull(), F.col(f"best_{m}")) for m in measures}
    last_month = F.col("last.date_key")
    age = months_apart(F.lit(ctx.as_of).cast("date"), last_month)
    retired = F.concat(F.lit("Z. retired_"), F.when(age <= 3, "recently").otherwise("long_ago"))
    money, money_rank, often, often_rank = (best[m] for m in measures)
    return users.select(
        "user_id",
        F.when(money_rank.isNull(), "retired").otherwise("active").alias("pay_user_type"),
        F.coalesce(money, retired).alias("current_monetary_type"),
        F.coalesce(often, retired).alias("current_frequency_type"),
        F.coalesce(money_rank, F.lit(0)).alias("current_monetary_rank"),
        F.coalesce(often_rank, F.lit(0)).alias("current_frequency_rank"),
        F.coalesce(money, F.col("last.monthly_monetary_type")).alias("latest_active_monetary_type"),
        F.coalesce(often, F.col("last.monthly_frequency_type")).alias("latest_active_frequency_type"),
        last_month.alias("nearest_active_month"),
    )


@model(
    "pay_user_master_data",
    "ledger/pay_user_master_data",
    after=("monthly_pay_user", "monthly_segmentation", "pay_user_flagging"),
    sort_by=("user_id", "transaction_id"),
)
def pay_user_master_data(ctx: Context) -> DataFrame:
    """Ledger rows with the user's tiers of that month, the user's flags and profile, and an amount band.

    Flags and profile hang on the user and are joined to the user's months first; the ledger then joins once, on user
    and month. Months match NULL-safe, so rows without a date still get the flags of their user.
    """
    scale = float(ctx.var("tier_scale", 1.0))
    profile = ctx.source("user_master").select(
        "user_id",
        "user_alias",
        "suspended_at",
        "suspend_reason",
        F.col("country").alias("user_country_code"),
        "email_domain",
        "provider",
        "preferred_os_system",
        "is_suspicious_user",
        (F.col("is_sus_social") | F.col("is_suspicious_x_social")).alias("is_suspicious_social"),
        "analytics_user_contry_code",
    )
    months = ctx.ref("monthly_segmentation").join(ctx.ref("pay_user_flagging"), "user_id", "left")
    months = months.join(profile, "user_id", "left")
    months = months.withColumnsRenamed({"user_id": "_user", "date_key": "_month"})
    ledger = ctx.ref("monthly_pay_user").withColumn("_at", month_start(F.col("date_key")))
    same_month = F.col("_at").eqNullSafe(F.col("_month"))
    wide = ledger.join(months, (F.col("user_id") == F.col("_user")) & same_month, "left")
    band = bucket(F.col("usd_amount"), [b * scale for b in BAND_BOUNDS], BANDS, "others")
    return wide.withColumn("transaction_amount_group", band).drop("_user", "_month", "_at")


def _ledger_rows(ledger: DataFrame) -> DataFrame:
    """Spending per ledger row: spending is booked negative, so the sign turns."""
    return ledger.groupBy(
        F.to_date("created_at").alias("transaction_date"),
        F.col("created_at").alias("transaction_datetime"),
        "order_id",
        "user_id",
        F.col("id").cast("string").alias("consum_transaction_id"),
    ).agg((F.sum("amount") / -100).alias("usd_amount"))


@model("daily_transaction", "inline/daily_transaction")
def daily_transaction(ctx: Context) -> DataFrame:
    return _ledger_rows(ctx.source("billing_ledger"))


@model(
    "ledger_transaction",
    "merged/ledger_transaction",
    partition_by=("transaction_datetime", "MONTH"),
    unique_key=("consum_transaction_id",),
    version="transaction_datetime",
)
def ledger_transaction(ctx: Context) -> DataFrame:
    """The daily ledger for one window, over the merged state of the ledger."""
    version = ctx.var("ledger_version")
    merged = read_final(ctx.source("billing_ledger"), "id", version) if version else ctx.source("billing_ledger")
    return _ledger_rows(slice_of(ctx, merged, "created_at"))


@model("latest_follow", "inline/latest_follow")
def latest_follow(ctx: Context) -> DataFrame:
    """Newest follow per owner and follower within the last month (``follow_window`` months)."""
    follows = recent(ctx.source("channel_follow"), "created_at", ctx.as_of, int(ctx.var("follow_window", 1)), "months")
    channels = ctx.source("channel").select(F.col("id").alias("channel_id"), "owner_id")
    users = ctx.source("user_account").select(F.col("id").alias("follower_id"), "auto_follow")
    # The user is looked up for the newest rows only.
    owned = follows.join(channels, "channel_id", "left")
    newest = latest_per_key(owned, ["owner_id", "follower_id"], "created_at", "channel_id")
    rows = newest.join(users, "follower_id", "left")
    return rows.select(
        F.to_date("created_at").alias("date_key"),
        "owner_id",
        "follower_id",
        F.col("created_at").alias("followed_at"),
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz").alias("unfollowed_at"),
        F.lit(True).alias("following_status"),
        (F.coalesce("auto_follow", F.lit(0)) == 1).alias("is_auto_follow"),
        F.lit("follow").alias("note"),
    )


@model(
    "daily_follower_following",
    "merged/daily_follower_following",
    after=("latest_follow",),
    partition_by=("date_key", "MONTH"),
    unique_key=("owner_id", "follower_id", "date_key"),
    fixed_partition=True,
)
def daily_follower_following(ctx: Context) -> DataFrame:
    """Follow and unfollow events, kept over time."""
    latest = ctx.ref("latest_follow")
    if not ctx.is_incremental("daily_follower_following"):
        return latest
    # An ended follow changes only if the snapshot holds it again, and the snapshot starts with its window.
    since = F.to_date(back(ctx.as_of, int(ctx.var("follow_window", 1)), "months"))
    open_or_new = flag(F.col("following_status")) | (F.col("date_key") >= since)
    target = ctx.target("daily_follower_following").select(*latest.columns).where(open_or_new)
    return edge_diff(target, latest, ctx.now())


@model("latest_transfer_permission", "inline/latest_transfer_permission")
def latest_transfer_permission(ctx: Context) -> DataFrame:
    """Users on the allow list, matched by alias or, without one, by previous alias."""
    users = ctx.source("user_account")
    keyed = users.select(F.col("id").alias("user_id"), user_alias(users).alias("_alias"))
    listed = ctx.source("allow_list").where(F.col("alias").isNotNull())
    listed = listed.select(F.col("alias").cast("string").alias("_alias"), "alias")
    today = F.lit(ctx.as_of).cast("date")
    return keyed.join(listed, "_alias", "inner").select(
        today.alias("created_at"), "user_id", "alias", F.lit(True).alias("is_allowed"), today.alias("last_updated_at")
    )


@model(
    "transfer_permission_history",
    "merged/transfer_permission_history",
    after=("latest_transfer_permission",),
    partition_by=("created_at", "MONTH"),
    unique_key=("user_id",),
)
def transfer_permission_history(ctx: Context) -> DataFrame:
    """Grants and losses of the transfer permission, kept over time."""
    latest = ctx.ref("latest_transfer_permission")
    if not ctx.is_incremental("transfer_permission_history"):
        return latest
    target = ctx.target("transfer_permission_history").select(*latest.columns)
    changes = dim_diff(target, latest, ctx.as_of, strict=bool(ctx.var("strict_permissions", False)))
    return changes.select(*latest.columns)


@model("content_access", "normal/content_access", partition_by=("transaction_date", "DAY"))
def content_access(ctx: Context) -> DataFrame:
    """Revenue from bought assets since yesterday: consumption, order, product, creator's transaction and buyer."""
    kind = str(ctx.var("product_kind", "asset"))
    spending = ctx.source("billing_ledger").where("type = 'consumption'")
    spending = recent(spending, "created_at", ctx.as_of, int(ctx.var("access_days", 1)), "days")
    # The product test drops rows without a product, so orders and products join inner, products first.
    products = ctx.source("ecom_product").where(F.col("type") == kind)
    products = products.select(F.col("id").alias("product_id"), F.col("type").alias("product_type"), "subtype")
    orders = ctx.source("ecom_order").select(
        F.col("id").alias("order_id"), F.col("event_code").alias("order_event"), "product_id", "billing_transaction_id"
    )
    creators = ctx.source("revenue_transaction").select(
        F.col("id").alias("billing_transaction_id"), F.col("event_code").alias("revenue_event")
    ).withColumn("revenue_transaction_id", F.col("billing_transaction_id"))
    buyers = ctx.source("user_account").select(F.col("username").alias("user_id"), F.col("id").alias("buyer_id"))
    sold = orders.join(products, "product_id", "inner")
    sold = sold.join(creators, "billing_transaction_id", "left")
    rows = sold.join(spending.select("order_id", "id", "created_at", "user_id", "amount"), "order_id", "inner")
    rows = rows.join(buyers, "user_id", "left")
    out = rows.groupBy(
        F.to_date("created_at").alias("transaction_date"),
        F.col("created_at").alias("transaction_datetime"),
        F.coalesce("order_event", "revenue_event").alias("event_code"),
        "order_id",
        "product_id",
        F.col("id").cast("string").alias("consum_transaction_id"),
        "revenue_transaction_id",
        F.col("product_type").alias("type"),
        "subtype",
        F.col("buyer_id").alias("user_id"),
    ).agg((F.sum("amount") / -100).alias("usd_amount"))
    limit = ctx.var("limit")
    return out if limit is None else out.limit(int(limit))


@model("campaign_push", "normal/campaign_push", partition_by=("created_at", "DAY"))
def campaign_push(ctx: Context) -> DataFrame:
    """Events since a day whose raw properties mention a campaign, with twelve properties as columns."""
    events = ctx.source("analytics_event")
    since = F.lit(ctx.var("campaign_since", "2025-02-06")).cast("date")
    mentioned = events.where((F.col("created_at") >= since) & F.col("properties").like(f"%{ctx.var('campaign')}%"))
    return with_json_strings(mentioned, "properties", PUSH_PROPERTIES).select(
        "distinct_id",
        "created_at",
        "event",
        "uuid",
        *PUSH_PROPERTIES,
        F.col("`$session_id`"),
        F.col("`$window_id`"),
        F.col("`$session_id_uuid`"),
        "person_mode",
    )


@model("slice_copy", "sliced/slice_copy", partition_by=("created_at", "MONTH"), sort_by=("created_at",))
def slice_copy(ctx: Context) -> DataFrame:
    """All columns of a table for one window."""
    return slice_of(ctx, ctx.source("sliced_table"), "created_at")


@model(
    "copied_table",
    "merged/copied_table",
    partition_by=("ingest_at", "MONTH"),
    unique_key=("creator_id", "ingest_cycle"),
    version="ingest_at",
    tie=("payout_id",),
)
def copied_table(ctx: Context) -> DataFrame:
    """A table copied from elsewhere, merged by creator and cycle; the latest ingest wins."""
    return ctx.source("copied_table")
