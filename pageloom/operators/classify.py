"""Is a page usable, and if not, why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import urls as U
from pageloom.operators import specs as S


def success_status(status: Column) -> Column:
    return status.between(200, 299)


def page_flags(pages: DataFrame, rule: str, domain: str = "") -> DataFrame:
    """Add origin, redirect and marker flags.

    ``listing``: 404 and 502 are parsed too, a marker counts where the fetch ended up, markers in
    the original address are only noted. ``detail``: any redirect makes the page unusable, the
    markers along the way only name the reason.
    """
    if rule not in ("listing", "detail"):
        raise ValueError(f"unknown rule {rule!r}")
    redirected = F.coalesce(F.size("redirect_urls"), F.lit(0)) > 0
    origin = F.expr(U.origin_url("url", "redirect_urls"))
    first_source = F.try_element_at("redirect_urls", F.lit(1))
    on_site = F.expr(U.on_domain("coalesce(final_url, url)", [domain]) if domain else "true")

    def marked(text: Column, marker: str) -> Column:
        return F.coalesce(text.contains(marker), F.lit(False))

    if rule == "listing":
        seen = F.coalesce("final_url", "url")
        accepted = success_status(F.col("status")) | F.col("status").isin(404, 502)
    else:
        seen = F.concat_ws(" ", "redirect_urls", F.when(redirected, F.col("final_url")))
        accepted = success_status(F.col("status"))

    df = pages.select(
        "*",
        origin.alias("origin_url"),
        redirected.alias("redirected"),
        marked(first_source, S.ROBOT_MARKER).alias("origin_robot_error"),
        marked(first_source, S.EXPIRED_MARKER).alias("origin_expired"),
        marked(seen, S.ROBOT_MARKER).alias("robot_error"),
        marked(seen, S.EXPIRED_MARKER).alias("expired"),
        F.coalesce(accepted, F.lit(False)).alias("accepted"),
        on_site.alias("on_site"))
    usable = F.col("on_site") & F.col("accepted")
    if rule == "listing":
        usable = usable & ~F.col("robot_error") & ~F.col("expired")
    else:
        usable = usable & ~F.col("redirected")
    return df.withColumn("parsed", usable)


def _unusable() -> Column:
    """What keeps a page from being parsed; NULL when nothing does."""
    return (F.when(~F.col("on_site"), "off_site")
            .when(F.col("status").isNull(), "not_fetched")
            .when(~F.col("accepted"), "bad_status")
            .when(F.col("parsed"), F.lit(None))
            .when(F.col("robot_error"), "robot_error")
            .when(F.col("expired"), "expired")
            .otherwise("redirected"))


def listing_outcome(df: DataFrame) -> DataFrame:
    """``outcome`` and ``reason`` of listing pages; a page without a record is 'empty'.

    The reason of an empty page tells a past-the-end page from an error status.
    """
    outcome = F.coalesce(_unusable(), F.when(F.col("n_records") > 0, "ok").otherwise("empty"))
    df = df.withColumn("outcome", outcome)
    by_status = F.concat(F.lit("status_"), F.col("status").cast("string"))
    reason = (F.when(F.col("outcome") == "ok", F.lit(None))
              .when(F.col("outcome") == "bad_status", by_status)
              .when((F.col("outcome") == "empty") & ~success_status(F.col("status")), by_status)
              .otherwise(F.col("outcome")))
    return df.withColumn("reason", reason)


def detail_outcome(df: DataFrame) -> DataFrame:
    """``outcome`` and ``reason`` of detail pages; a missing required field is a failure."""
    failed = F.size("missing_fields") > 0
    outcome = F.coalesce(_unusable(), F.when(failed, "extract_failed").otherwise("ok"))
    df = df.withColumn("outcome", outcome)
    reason = (F.when(F.col("outcome") == "ok", F.lit(None))
              .when(F.col("outcome") == "extract_failed",
                    F.concat(F.lit("missing "), F.array_join("missing_fields", ",")))
              .when(F.col("outcome") == "bad_status",
                    F.concat(F.lit("status_"), F.col("status").cast("string")))
              .otherwise(F.col("outcome")))
    return df.withColumn("reason", reason)


def has_work(url: Column) -> Column:
    """A message with an address; one without is acknowledged and nothing else happens."""
    return F.coalesce(url != "", F.lit(False))
