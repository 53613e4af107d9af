"""A shipping log split into dimensions, facts and a delivery mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import delay_days, flag, profit, split_part, tax, whole_days
from martwright.operators import distinct_rows, keep_in, lookup, milestone, star, surrogate_id
from martwright.session import materialize

RATE = "decimal(14,3)"


def country_rates(shipping: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Country and base rate with an id; members of an ``existing`` dimension keep theirs."""
    pairs = distinct_rows(shipping, ["shipping_country", "shipping_country_base_rate"])
    return surrogate_id(pairs, ["shipping_country", "shipping_country_base_rate"], "shipping_country_id", existing)


def _agreement_parts(text: str) -> list:
    return [
        split_part(text, ":", 1).try_cast("long").alias("agreementid"),
        split_part(text, ":", 2).alias("agreement_number"),
        split_part(text, ":", 3).try_cast(RATE).alias("agreement_rate"),
        split_part(text, ":", 4).try_cast(RATE).alias("agreement_commission"),
    ]


def agreements(shipping: DataFrame) -> DataFrame:
    """Vendor agreements from ``id:number:rate:commission``; a missing part is NULL."""
    return distinct_rows(shipping, _agreement_parts("vendor_agreement_description"))


def transfers(shipping: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Transfer type, model and rate from ``type:model`` with an id; members of an ``existing`` dimension keep theirs."""
    text = "shipping_transfer_description"
    rows = distinct_rows(
        shipping,
        [
            split_part(text, ":", 1).alias("transfer_type"),
            split_part(text, ":", 2).alias("transfer_model"),
            "shipping_transfer_rate",
        ],
    )
    keys = ["transfer_type", "transfer_model", "shipping_transfer_rate"]
    return surrogate_id(rows, keys, "transfer_type_id", existing)


def shipping_info(shipping: DataFrame, transfer_dim: DataFrame, country_dim: DataFrame) -> DataFrame:
    """One row per shipment with the ids of its transfer, country and agreement.

    The small dimensions are looked up first, so the shuffle of the distinct
    carries ids instead of texts. The rates are part of the dimension keys, so
    a row never matches twice.
    """
    text = "shipping_transfer_description"
    rows = shipping.select(
        "shippingid",
        "vendorid",
        "shipping_plan_datetime",
        "payment_amount",
        split_part(text, ":", 1).alias("transfer_type"),
        split_part(text, ":", 2).alias("transfer_model"),
        "shipping_transfer_rate",
        "shipping_country",
        "shipping_country_base_rate",
        split_part("vendor_agreement_description", ":", 1).try_cast("long").alias("agreementid"),
    )
    rows = star(
        rows,
        [
            (transfer_dim, ["transfer_type", "transfer_model", "shipping_transfer_rate"], ["transfer_type_id"]),
            (country_dim, ["shipping_country", "shipping_country_base_rate"], ["shipping_country_id"]),
        ],
    )
    columns = ["shippingid", "vendorid", "shipping_plan_datetime", "payment_amount"]
    return distinct_rows(rows, [*columns, "transfer_type_id", "shipping_country_id", "agreementid"])


def shipping_status(shipping: DataFrame, start_state: str = "booked", end_state: str = "recieved") -> DataFrame:
    """Latest status of each shipment with the last booked and received times; equal latest times all stay.

    The times are aggregated (combined before the shuffle) and the latest rows
    are found by a join on (shipment, time), so no task sorts a whole shipment.
    """
    times = shipping.groupBy("shippingid").agg(
        F.max("state_datetime").alias("state_datetime"),
        milestone("state", start_state, "state_datetime").alias("shipping_start_fact_datetime"),
        milestone("state", end_state, "state_datetime").alias("shipping_end_fact_datetime"),
    )
    rows = distinct_rows(shipping, ["shippingid", "status", "state", "state_datetime"])
    return rows.join(times, ["shippingid", "state_datetime"]).drop("state_datetime")


def latest_states(shipping: DataFrame) -> DataFrame:
    """Log rows at the latest time of their shipment (tuple IN form)."""
    latest = shipping.groupBy("shippingid").agg(F.max("state_datetime").alias("state_datetime"))
    return keep_in(shipping, latest, ["shippingid", "state_datetime"])


def shipping_datamart(
    info: DataFrame,
    status: DataFrame,
    transfer_dim: DataFrame,
    agreement_dim: DataFrame,
    country_dim: DataFrame,
) -> DataFrame:
    """Delivery time, delay, tax and profit per shipment."""
    rows = info.join(status, "shippingid")
    rows = lookup(rows, transfer_dim, ["transfer_type_id"], ["transfer_type", "shipping_transfer_rate"])
    rows = lookup(rows, agreement_dim, ["agreementid"], ["agreement_rate", "agreement_commission"])
    rows = lookup(rows, country_dim, ["shipping_country_id"], ["shipping_country_base_rate"])
    end, plan = F.col("shipping_end_fact_datetime"), F.col("shipping_plan_datetime")
    return rows.select(
        "shippingid",
        "vendorid",
        "transfer_type",
        whole_days("shipping_start_fact_datetime", end).alias("full_day_at_shipping"),
        flag(end > plan).alias("is_delay"),
        flag(F.col("status") == "finished").alias("is_shipping_finish"),
        "shipping_end_fact_datetime",
        "shipping_plan_datetime",
        delay_days(end, plan).alias("delay_day_at_shipping"),
        "payment_amount",
        tax("payment_amount", "shipping_country_base_rate", "agreement_rate", "shipping_transfer_rate").alias("vat"),
        profit("payment_amount", "agreement_commission").alias("profit"),
    )


def shipping_tables(
    shipping: DataFrame, known_transfers: DataFrame | None = None, known_rates: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All tables of the model and the mart; ids go on from the known dimensions of an earlier load."""
    transfer_dim, country_dim = transfers(shipping, known_transfers), country_rates(shipping, known_rates)
    # Used by the size check and by the join: written once so the log is not scanned again.
    agreement_dim = materialize(agreements(shipping))
    info, status = shipping_info(shipping, transfer_dim, country_dim), shipping_status(shipping)
    return {
        "shipping_transfer": transfer_dim,
        "shipping_country_rates": country_dim,
        "shipping_agreement": agreement_dim,
        "shipping_info": info,
        "shipping_status": status,
        "shipping_datamart": shipping_datamart(info, status, transfer_dim, agreement_dim, country_dim),
    }
