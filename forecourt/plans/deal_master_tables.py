"""Deal master and margin base on the warehouse-shaped deal tables (FIXTURES.md §2 names).

The same plan as ``plans/deals.py`` (which runs on the test-table roles), written against the
sales schema: deal selection, lookups, inside-sales owner, listing price, token payments,
receivables with the visit fan-out, refund, insurance, loan status and lead source, then the
wide GROUP BY. Joins that feed no output column and cannot change the row count (content type,
trading partner, loan lead owner, visit creator, documents-received date, the users inside the
payment sub-select) are left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions import columns as C
from forecourt.functions import rules
from forecourt.operators import aggs, joins, latest, windows
from forecourt.operators.joins import merge_null_safe
from forecourt.plans.contract import DEAL_MASTER_COLUMNS

# Fixed values of the source workload (codes and labels that are not brand names).
INSIDE_SALES_CONTEXT_TYPE = 188
LISTING_PRICE_LABEL = 1
LISTING_PRICE_TARGET_TYPE = 27
DEAL_CONTEXT_TYPE = 238
TOKEN_ITEM = "Token"
APPROVED = "approved"
VISIT_TYPE = 2
WEB_ARTICLE, EXT_PLATFORM, EXT_REQUEST = 246, 319, 321
DEFAULT_SOURCE_LABELS = ((356, "Inbound"), (301, "Walk-in"), (342, "Whatsapp"), (5, "Assured Redirect"),
                         (60, "Buyrequest"))
#: Source object types that must have a label; 187's is a brand name and has no default.
SOURCE_CODES = (187, 356, 301, 342, 5, 60)
DIRECT_SOURCE_CODES = (249, 27, 197, 136, 309)
PAPER_TRANSFER_COST, WARRANTY_COST = 4800, 1500
BANK_LOG_SPECS = [("approved_date", 4, "max"), ("rejected_date_bank", 5, "min"), ("bank_login_date", 0, "max")]
LOAN_LOG_SPECS = [("app_rejected_date", 3, "min"), ("app_login_date", 6, "max")]

MASTER_COLUMNS = DEAL_MASTER_COLUMNS


def _sel(df: DataFrame, **cols: str) -> DataFrame:
    """Project and rename: ``_sel(t, new="old", ...)``."""
    return df.select(*[F.col(old).alias(new) for new, old in cols.items()])


def deal_ids(tb: Mapping[str, DataFrame], category: str, floor: str) -> DataFrame:
    """Previous delivered deals of the same month (per buy lead, excluded statuses removed
    first) UNION the latest deal per buy lead and month from ``floor`` (local date)."""
    status = _sel(tb["status"], _st="id", description="description")
    deals = tb["deal"].join(status, F.col("status_id") == F.col("_st"))
    leads = tb["buy_lead"].filter(F.col("category") == category).select(F.col("id").alias("_bl"))
    repeat = windows.repeat_deals(deals.join(leads, F.col("_bl") == F.col("buy_lead_id")),
                                  "buy_lead_id", "created_time", "id", "description",
                                  previous_status=rules.DELIVERY_DONE, excluded=rules.EXCLUDED_DEAL_STATUSES)
    monthly = (deals.filter(C.local_floor("created_time", floor)
                            & ~F.col("description").isin(*rules.EXCLUDED_DEAL_STATUSES))
               .groupBy("buy_lead_id", C.month_of("created_time").alias("_m"))
               .agg(F.max("id").alias("id")).select("id"))
    return repeat.unionByName(monthly)


def loan_status_from_tables(tb: Mapping[str, DataFrame]) -> DataFrame:
    """CP3 on the loan tables: latest application per deal, its latest bank application, the
    bank name, the two status-log pivots (by bank application and by application), the deal's
    status and flags, the decision table, DISTINCT."""
    applications = latest.latest_per_key(tb["loan_app"].select("id", "deal_id", "created_at", "lead_status"),
                                ["deal_id"], "id", how="semi")
    fundings = latest.latest_per_key(
        tb["bank_loan_app"].select("id", "loan_app_id", "bank_id", "status", "net_disbursed_amount"),
        ["loan_app_id"], "id", how="semi")
    fundings = _sel(fundings, _ba_id="id", _ba_app="loan_app_id", _ba_bank="bank_id", bank_status="status",
                 net_disbursed_amount="net_disbursed_amount")
    bank = _sel(tb["bank"], _bank="id", loan_vendor="display_name")
    log = tb["loan_log"]
    by_bank = aggs.status_pivot(log, "bank_loan_application_id", "created_at", "bank_loan_status",
                                BANK_LOG_SPECS, offset_minutes=C.LOCAL_OFFSET_MINUTES)
    by_app = aggs.status_pivot(log, "loan_application_id", "created_at", "loan_status",
                               LOAN_LOG_SPECS, offset_minutes=C.LOCAL_OFFSET_MINUTES)
    status = _sel(tb["status"], _st="id", deal_status="description")
    agreed = (tb["deal"].select(F.col("id").alias("_agreed_deal"), "status_id", "loan_facilitation", "self_loan")
           .join(status, F.col("_st") == F.col("status_id")))
    j = (applications.join(fundings, F.col("_ba_app") == F.col("id"), "left")
            .join(bank, F.col("_bank") == F.col("_ba_bank"), "left")
            .join(by_bank, F.col("bank_loan_application_id") == F.col("_ba_id"), "left")
            .join(by_app, F.col("loan_application_id") == F.col("id"), "left")
            .join(agreed, F.col("_agreed_deal") == F.col("deal_id")))
    j = rules.decision_table(j, "lead_status", "bank_status", "deal_status")
    return j.select(
        F.col("id").alias("loan_id"), F.col("_agreed_deal").alias("deal_id"),
        C.local_time("created_at").alias("loan_confirmation_date"),
        C.nullif("app_login_date", "bank_login_date").alias("login_date"),
        C.nullif("app_rejected_date", "rejected_date_bank").alias("rejected_date"),
        "approved_date", "loan_vendor", "net_disbursed_amount",
        C.three_way_label("self_loan", "loan_facilitation", "Yes-Self Loan", "Yes", "No").alias("loanyn"),
        "loan_flow_status").distinct()


def merged_source_labels(given: Sequence[tuple[int, str]]) -> list[tuple[int, str]]:
    """The given labels over the default ones; a code without a label is an error, since its leads
    would all turn into 'Others'."""
    labels = {**dict(DEFAULT_SOURCE_LABELS), **dict(given)}
    missing = [c for c in SOURCE_CODES if not labels.get(c)]
    if missing:
        raise ValueError(f"source_labels: no label for source object type {', '.join(map(str, missing))}")
    return list(labels.items())


def lead_sources_from_tables(
    tb: Mapping[str, DataFrame],
    url_rules: Sequence[tuple[str, str]],
    code_labels: Sequence[tuple[int, str]],
    direct_codes: Sequence[int] = DIRECT_SOURCE_CODES,
    direct_label: str = "Other Direct",
) -> DataFrame:
    """Lead source per buy lead (polymorphic foreign key on the source object type).

    The contact and content-type joins are inner, so a lead without either has no row here and
    gets a null source through the outer left join.
    """
    bl = tb["buy_lead"].select(F.col("id").alias("lead_id"), "contact_details_id",
                               F.col("source_object_type_id").alias("src_type"),
                               F.col("source_object_id").alias("src_id"))
    bl = (bl.join(tb["contact"].select(F.col("id").alias("_contact")), F.col("_contact") == F.col("contact_details_id"))
            .join(tb["content_type"].select(F.col("id").alias("_ct")), F.col("_ct") == F.col("src_type")))
    article = _sel(tb["web_article"], _wa="id", url="url")
    platform = _sel(tb["platform"], _pf="id", platform_name="display_name")
    request = _sel(tb["ext_request"], _rq="id", _rq_listing="listing_id")
    resolved = joins.polymorphic_lookup(bl, "src_type", "src_id", [
        (WEB_ARTICLE, article, "_wa"), (EXT_PLATFORM, platform, "_pf"), (EXT_REQUEST, request, "_rq")])
    resolved = joins.lookup_chain(resolved, [
        (_sel(tb["ext_listing"], _el="id", _el_account="account_id"), F.col("_el") == F.col("_rq_listing"), False),
        (_sel(tb["platform_account"], _pa="id", _pa_platform="platform_id"), F.col("_pa") == F.col("_el_account"), False),
        (_sel(tb["platform"], _pf2="id", request_platform="display_name"), F.col("_pf2") == F.col("_pa_platform"), False),
    ])
    url_bucket = C.pattern_bucket("url", url_rules, passthrough=True)
    code = F.col("src_type")
    fixed = [(c, F.lit(lbl)) for c, lbl in code_labels] + [(list(direct_codes), F.lit(direct_label))]
    label = rules.code_dispatch(code, [(WEB_ARTICLE, url_bucket), (EXT_PLATFORM, F.col("platform_name")),
                                       (EXT_REQUEST, F.col("request_platform")), *fixed], F.lit("Others"))
    suffixed = rules.code_dispatch(code, [
        (WEB_ARTICLE, C.with_suffix(url_bucket, " - Webarticle")),
        (EXT_PLATFORM, C.with_suffix("platform_name", " - External Platform")),
        (EXT_REQUEST, C.with_suffix("request_platform", " - External Platform")), *fixed], F.lit("Others"))
    return resolved.select(F.col("lead_id").alias("_src_lead"), label.alias("sub_sub_source_f"),
                           suffixed.alias("sub_sub_source"))


def deal_master_from_tables(
    tb: Mapping[str, DataFrame],
    *,
    category: str,
    hub_rules: Sequence[tuple[str, str]],
    url_rules: Sequence[tuple[str, str]],
    selection_floor: str = "2021-10-01",
    created_floor: str = "2021-10-01",
    mask_pii: bool = True,
    source_labels: Sequence[tuple[int, str]] = (),
    direct_label: str = "Other Direct",
) -> DataFrame:
    """One wide row per selected deal and per distinct value of the one-to-many sides that
    carry output columns (listing date, procured price, refund status), as in the source.

    ``category`` is the buy-lead category kept; ``hub_rules`` and ``url_rules`` are the ordered
    LIKE rules for hub names and web-article urls (both pass the input through when nothing
    matches). ``created_floor`` compares the UTC date, ``selection_floor`` the local date.
    """
    deal = tb["deal"]
    ids = deal_ids(tb, category, selection_floor).withColumnRenamed("id", "_sel_id")
    cp = deal.join(ids, F.col("id") == F.col("_sel_id"), "left_semi")
    status = _sel(tb["status"], _st="id", description="description")
    bl = tb["buy_lead"].select(F.col("id").alias("_bl"), F.col("category").alias("_bl_category"),
                               F.col("contact_details_id").alias("_bl_contact"))
    profile = tb["lead_profile"].select(F.col("id").alias("_lp"), "make_id", "model_id", "variant_id", "color",
                                        "fuel_type", "registration_no", "make_year", "mileage", "no_of_owners")
    lead = tb["lead"].select(F.col("id").alias("_l"), F.col("profile_id").alias("_l_profile"),
                             F.col("procurement_category").alias("_procurement_category"))
    listing = tb["listing"].select(F.col("lead_id").alias("_ll_lead"), "added_on")
    names = {k: _sel(tb[k], **{f"_{k}": "id", f"{k}_name": "display_name"}) for k in ("hub", "make", "model", "variant")}
    users = tb["user"]

    tasks = tb["user_task"].filter((F.col("context_type_id") == INSIDE_SALES_CONTEXT_TYPE)
                                   & F.col("finished_by_id").isNotNull())
    closers = latest.owner_by_max_id(tasks, "context_id", "finished_by_id", users, "id", "full_name", "inside_sales")
    closers = closers.withColumnRenamed("context_id", "_closer_lead")
    contact = tb["contact"].select(F.col("id").alias("_cd"), F.col("name").alias("_buyer_name"),
                                   F.col("contact_number").alias("_buyer_number"))
    visits = (tb["visit"].filter(F.col("visit_start_time").isNotNull() & (F.col("visit_type_id") == VISIT_TYPE)
                                 & (F.col("scheduled_visit") == 1))
              .select("buy_lead_id", "created_by_id").distinct()
              .groupBy(F.col("buy_lead_id").alias("_v_lead")).agg(F.count(F.lit(1)).alias("_visits")))
    hub_sales = _sel(users, _creator="id", hub_sales="full_name")
    procured = _sel(tb["procured_car"], _pc_lead="lead_id", procurement_price="price")
    prices = tb["price_value"].filter((F.col("label_id") == LISTING_PRICE_LABEL)
                                      & (F.col("target_object_type_id") == LISTING_PRICE_TARGET_TYPE)
                                      & F.col("created_by_id").isNotNull())
    asked_prices = _sel(latest.latest_per_key(prices.select("id", "target_object_id", "value"), ["target_object_id"], "id",
                                     how="max_by"), _asked_lead="target_object_id", listing_price="value")
    pay = (tb["payment_order"].filter(F.col("context_type_id") == DEAL_CONTEXT_TYPE)
           .join(tb["payment"], F.col("order_id") == tb["payment_order"]["id"], "left")
           .join(_sel(tb["payment_item"], _item="id", item_name="name"), F.col("_item") == F.col("item_id"), "left")
           .filter((F.col("item_name") == TOKEN_ITEM) & (F.col("status") == APPROVED)))
    token_payments = pay.groupBy(F.col("context_id").alias("_token_deal")).agg(F.sum("amount").alias("token_amount"))
    receivables = (tb["receivable"].filter(F.col("status") == APPROVED)
                   .groupBy("contract_id").agg(F.sum("amount").alias("_contract_sum")))
    per_deal_receivable = (tb["contract"].join(receivables, F.col("contract_id") == tb["contract"]["id"], "left")
                           .groupBy(F.col("trade_object_id").alias("_pr_deal"))
                           .agg(F.sum("_contract_sum").alias("_receivable_sum")))
    refund = _sel(tb["refund_request"], _cpr_deal="deal_id", refund_status="status")
    insurance = (tb["registration_check"].groupBy(F.col("lead_id").alias("_lrv_lead"))
                 .agg(F.max("insurance_validity").alias("insurance_validity_date")))
    loan = loan_status_from_tables(tb).select(
        F.col("deal_id").alias("_loan_deal"), "loan_vendor", "loan_flow_status", "login_date", "approved_date",
        "rejected_date", "net_disbursed_amount", "loan_confirmation_date")
    sources = lead_sources_from_tables(tb, url_rules, merged_source_labels(source_labels), direct_label=direct_label)

    # Joins are grouped by key so the wide deal stream is re-partitioned once per key
    # (buy lead, contact, sell lead, profile, creator, deal) instead of once per join; small
    # dimensions are broadcast by AQE when their measured size allows.
    # The two lead chains split hot leads themselves (a buyer or a fleet seller with a large share of the deals).
    rows = joins.salted_lookups(
        cp.join(status, F.col("_st") == F.col("status_id"), "left"), "buy_lead_id",
        [(bl, "_bl", "left"), (closers, "_closer_lead", "left"), (visits, "_v_lead", "left"), (sources, "_src_lead", "left")],
        key_rows=deal.select("buy_lead_id"))
    rows = (rows.filter(C.utc_floor("created_time", created_floor) & (F.col("_bl_category") == category)
                        & ~F.col("description").isin(*rules.EXCLUDED_DEAL_STATUSES))
            .join(contact, F.col("_cd") == F.col("_bl_contact"), "left"))
    # sell-lead keyed (the listing belongs to the lead row, so it needs one)
    listed = lead.join(listing, F.col("_ll_lead") == F.col("_l"), "left")
    rows = joins.salted_lookups(
        rows, "sell_lead_id", [(listed, "_l", "left"), (procured, "_pc_lead", "left"), (asked_prices, "_asked_lead", "left"),
                               (insurance, "_lrv_lead", "left")], key_rows=deal.select("sell_lead_id"))
    rows = (rows
              .join(profile, F.col("_lp") == F.col("_l_profile"), "left")
              .join(names["make"], F.col("_make") == F.col("make_id"), "left")
              .join(names["model"], F.col("_model") == F.col("model_id"), "left")
              .join(names["variant"], F.col("_variant") == F.col("variant_id"), "left")
              .join(names["hub"], F.col("_hub") == F.col("deal_hub_id"), "left")
              .join(hub_sales, F.col("_creator") == F.col("created_by_id"), "left")
              # deal keyed, last: the final GROUP BY contains the deal id
              .join(token_payments, F.col("_token_deal") == F.col("id"), "left")
              .join(per_deal_receivable, F.col("_pr_deal") == F.col("id"), "left")
              .join(refund, F.col("_cpr_deal") == F.col("id"), "left")
              .join(loan, F.col("_loan_deal") == F.col("id"), "left"))
    # SUM(receivable) over the visit fan-out = receivables of the deal x visit rows of the lead.
    rows = rows.select(
        "*",
        (F.col("_receivable_sum") * F.greatest(F.coalesce("_visits", F.lit(1)), F.lit(1))).alias("_payment"),
        # GROUP BY names that are select aliases group by the expression (D3): the listing date,
        # the approved/rejected date and the two flag labels; the other names are raw columns.
        C.local_date("added_on").alias("car_live_date"),
        C.nullif(F.to_date("approved_date"), F.to_date("rejected_date")).alias("approved_rejected_date"),
        C.flag_label("loan_facilitation").alias("loan_interest"),
        C.two_flag_label("loan_facilitation", "self_loan").alias("self_loan_interest"))
    keys = ["_bl", "id", "description", "sell_lead_id", "registration_no", "hub_name", "make_name", "model_name",
            "variant_name", "color", "make_year", "mileage", "fuel_type", "no_of_owners", "buy_lead_id",
            "sub_sub_source_f", "sub_sub_source", "_buyer_name", "_buyer_number", "inside_sales", "hub_sales",
            "procurement_price", "listing_price", "final_amount", "insurance_renewal", "insurance_renewal_amount",
            "created_time", "token_amount", "target_delivery_time", "loan_interest", "self_loan_interest",
            "loan_vendor", "loan_flow_status", "login_date", "approved_rejected_date",
            "net_disbursed_amount", "delivery_time", "deal_cancellation_time", "cancellation_reason",
            "car_return_time", "car_return_reason", "car_live_date", "loan_confirmation_date", "_bl_category",
            "_procurement_category", "refund_status", "insurance_validity_date"]
    g = rows.groupBy(*keys).agg(F.sum("_payment").alias("payment_amount"))
    masked = F.lit(None).cast("string")
    return g.select(
        F.col("id").alias("deal_id"),
        C.relabel("description", rules.DEAL_STATUS_LABELS).alias("deal_status"),
        "sell_lead_id", "registration_no",
        C.pattern_bucket("hub_name", hub_rules, passthrough=True).alias("deal_hub"),
        F.col("make_name").alias("make"), F.col("model_name").alias("model"), F.col("variant_name").alias("variant"),
        "color", "make_year", "mileage", "fuel_type", "no_of_owners", "buy_lead_id", "sub_sub_source_f",
        (masked if mask_pii else F.col("_buyer_name")).alias("buyer_name"),
        (masked if mask_pii else F.col("_buyer_number")).alias("buyer_number"),
        "inside_sales", "hub_sales", "procurement_price", "listing_price",
        F.col("final_amount").alias("sell_price"),
        F.lit(PAPER_TRANSFER_COST).alias("paper_transfer_cost"), F.lit(WARRANTY_COST).alias("warranty_cost"),
        "insurance_validity_date", "payment_amount", "token_amount",
        "car_live_date",
        C.local_date("created_time").alias("token_date"),
        C.local_date("target_delivery_time").alias("edd1"),
        "loan_interest", "loan_vendor", "loan_flow_status",
        F.to_date("login_date").alias("login_date"),
        "approved_rejected_date", "net_disbursed_amount", "self_loan_interest", "refund_status",
        C.local_date("delivery_time").alias("delivery_time"),
        C.local_date("deal_cancellation_time").alias("deal_cancellation_time"),
        "cancellation_reason",
        C.local_date("car_return_time").alias("car_return_time"),
        "car_return_reason",
    )


def margin_base_from_tables(deal_master: DataFrame, refurb: DataFrame) -> DataFrame:
    """Deal master left-merged with the refurb cost on the sell lead (null keys match), the
    registration column dropped, the listing date as a timestamp."""
    merged = merge_null_safe(deal_master, refurb, "sell_lead_id").drop("reg_no")
    return merged.withColumn("car_live_date", F.col("car_live_date").cast("timestamp_ntz")).select(
        *MASTER_COLUMNS, "actual_refurb_cost")

