"""Scores, flags and prices computed row by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds, weights and labels.
MATCH_RENT_MIN, MATCH_RENT_MAX, MATCH_LAND_MIN = 6000, 14000, 4000
MIN_PLAUSIBLE_LAND = 100
SCORE_WEBSITE, SCORE_PHONE, SCORE_RATING, SCORE_REVIEWS = 30, 25, 30, 15
GOOD_RATING, MANY_REVIEWS = 4.0, 50
TIERS = ((40, "hot lead"), (70, "established"), (100, "benchmark"))
VOL_WARN, VOL_BREACH = 0.30, 0.45
OPEN_PRICE_LABEL = "Sob consulta"
OPEN_BASKET_LABEL = "A combinar"
OPEN_BASKET_SUFFIX = " + a combinar"
EMPTY_BASKET_LABEL = "—"


def is_match(
    rent: Column,
    land: Column,
    rent_min: int = MATCH_RENT_MIN,
    rent_max: int = MATCH_RENT_MAX,
    land_min: int = MATCH_LAND_MIN,
) -> Column:
    """1 when rent lies in the wanted range and the plot is large enough, else 0."""
    wanted = (rent != 0) & (land != 0) & rent.between(rent_min, rent_max) & (land >= land_min)
    return F.coalesce(wanted, F.lit(False)).cast("int")


def price_per_m2(rent: Column, land: Column) -> Column:
    """Rent per square metre to 3 decimals; NULL for implausibly small plots."""
    return F.when(
        (rent != 0) & (land >= MIN_PLAUSIBLE_LAND), F.round(F.try_divide(rent, land), 3)
    )


def digital_score(website: Column, phone: Column, rating: Column, reviews: Column) -> Column:
    """0–100 sum of four signals."""

    def points(signal: Column, weight: int) -> Column:
        return F.when(signal, weight).otherwise(0)

    return (
        points(website, SCORE_WEBSITE)
        + points(phone, SCORE_PHONE)
        + points(rating >= GOOD_RATING, SCORE_RATING)
        + points(reviews >= MANY_REVIEWS, SCORE_REVIEWS)
    )


def digital_tier(score: Column) -> Column:
    (low, cold), (middle, known), (_, best) = TIERS
    return F.when(score <= low, cold).when(score <= middle, known).otherwise(best)


def risk_flag(volatility: Column, warn: float = VOL_WARN, breach: float = VOL_BREACH) -> Column:
    """BREACH, WARN or OK; an unknown (NULL) volatility is OK."""
    return F.when(volatility >= breach, "BREACH").when(volatility >= warn, "WARN").otherwise("OK")


def effective_price(variant_price: Column, product_price: Column) -> Column:
    return F.coalesce(variant_price, product_price)


def money_text(amount: Column) -> Column:
    """`R$ 1.234,56`, with a no-break space after the sign as the locale prints it."""
    swapped = F.translate(F.format_number(F.abs(amount), 2), ",.", ".,")
    sign = F.when(amount < 0, "-").otherwise("")
    return F.concat(sign, F.lit("R$ "), swapped)


def price_label(price: Column) -> Column:
    return F.when(price.isNull(), OPEN_PRICE_LABEL).otherwise(money_text(price))


def basket_label(total: Column, has_open: Column, lines: Column) -> Column:
    """Total of a basket, saying so when some prices are still open."""
    return (
        F.when(lines == 0, EMPTY_BASKET_LABEL)
        .when(has_open & (total == 0), OPEN_BASKET_LABEL)
        .when(has_open, F.concat(money_text(total), F.lit(OPEN_BASKET_SUFFIX)))
        .otherwise(money_text(total))
    )
