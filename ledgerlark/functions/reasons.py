"""Plain-language reason texts for feature contributions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# One text per model feature.
REASON_TEMPLATES = {
    "total_carrier_claims": "Claim volume {value:.0f} ({direction} peer average)",
    "carrier_claims_per_bene": "Claims per beneficiary {value:.1f} ({direction} peer average)",
    "claim_volume_growth_pct": "Claim volume growth {value:+.1f}% vs prior period ({direction} normal range)",
    "distinct_hcpcs_codes": "Billed {value:.0f} distinct procedure codes ({direction} peer average)",
    "top_hcpcs_code_share": "Top procedure code accounts for {value:.0%} of all claims ({direction} peer)",
    "hcpcs_concentration_score": "Procedure code concentration score {value:.3f} ({direction} peer average)",
    "avg_submitted_to_allowed_ratio": "Average submitted-to-allowed ratio {value:.2f}x ({direction} peer average)",
    "p95_submitted_to_allowed_ratio": "95th-pct submitted-to-allowed ratio {value:.2f}x ({direction} peer average)",
    "distinct_beneficiaries": "Served {value:.0f} distinct beneficiaries ({direction} peer average)",
    "avg_claims_per_beneficiary": "Average {value:.1f} claims per beneficiary ({direction} peer average)",
    "beneficiaries_per_state": "Beneficiaries spread across {value:.0f} states ({direction} expected for specialty)",
    "high_chronic_burden_benes_pct": "{value:.0%} of beneficiaries have 3+ chronic conditions ({direction} peer average)",
    "pct_weekend_claims": "{value:.0%} of claims billed on weekends ({direction} peer average)",
    "max_claims_in_single_day": "Peak of {value:.0f} claims billed in a single day ({direction} peer maximum)",
    "exact_duplicate_count": "{value:.0f} exact duplicate claim pairs detected",
    "near_duplicate_count": "{value:.0f} near-duplicate claim pairs detected (same code, 3-day window)",
    "duplicate_rate": "Duplicate rate {value:.2%} ({direction} peer average)",
    "claims_after_bene_death": "{value:.0f} claims billed after beneficiary death date",
}
FALLBACK_TEMPLATE = "Feature '{feature}' value {value:.4f} ({direction} expected)"

_VALUE = re.compile(r"\{value:([^}]*)\}")
_FIELD = re.compile(r"\{(\w+)\}")

_FRACTION_BITS = 62
_MAX_DIGITS = 4


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(value: Column, digits: Column, percent: Column, plus: Column) -> Column:
    """The value with so many decimals, rounded from its exact binary value, halves to the even digit.

    All steps are exact: the fraction of a double times 2**62 is a whole number (for magnitudes from 2**-10; below
    that only bits past the last place that could decide are lost), and the rest is integer arithmetic.
    """
    unit, half = F.lit(1 << _FRACTION_BITS), F.lit(1 << (_FRACTION_BITS - 1))
    powers = F.array(*[F.lit(10**d) for d in range(_MAX_DIGITS + 1)])

    def split(f: Column) -> Column:
        size = F.abs(f["x"])
        bits = ((size - F.floor(size)) * float(1 << _FRACTION_BITS)).cast("bigint").cast("decimal(19,0)")
        power = F.element_at(powers, f["digits"] + 1).cast("decimal(5,0)")
        return _let(
            F.struct(f.alias("f"), F.floor(size).cast("decimal(19,0)").alias("whole"), (bits * power).alias("scaled"), power.alias("power")), round_
        )

    def round_(p: Column) -> Column:
        low = F.call_function("div", p["scaled"], unit)
        return _let(
            F.struct(
                p["f"].alias("f"),
                (p["scaled"] - low.cast("decimal(19,0)") * unit).alias("rest"),
                (p["whole"] * p["power"] + low).alias("total"),
            ),
            write,
        )

    def write(r: Column) -> Column:
        up = (r["rest"] > half) | ((r["rest"] == half) & (r["total"] % 2 == 1))
        text = (r["total"] + F.when(up, 1).otherwise(0)).cast("decimal(38,0)").cast("string")
        return _let(F.struct(r["f"].alias("f"), text.alias("text")), point)

    def point(t: Column) -> Column:
        f, digits = t["f"], t["f"]["digits"]
        padded = F.lpad(t["text"], F.greatest(F.length(t["text"]), digits + 1), F.lit("0"))
        body = _let(
            F.struct(padded.alias("t"), digits.alias("d")),
            lambda q: F.concat(
                F.substring(q["t"], F.lit(1), F.length(q["t"]) - q["d"]),
                F.when(q["d"] > 0, ".").otherwise(""),
                F.substring(q["t"], F.length(q["t"]) - q["d"] + 1, q["d"]),
            ),
        )
        sign = F.when(f["x"] < 0, "-").otherwise(F.when(f["plus"], "+").otherwise(""))
        return F.concat(sign, body, F.when(f["percent"], "%").otherwise(""))

    format_ = F.struct(value.cast("double").alias("v"), digits.alias("digits"), percent.alias("percent"), plus.alias("plus"))
    scaled = lambda f: F.struct(F.when(f["percent"], f["v"] * 100).otherwise(f["v"]).alias("x"), f["digits"], f["percent"], f["plus"])
    return _let(format_, lambda f: _let(scaled(f), split))


def _filled(text: str, feature: Column, direction: Column) -> Column:
    """The text with its feature and direction fields filled in."""
    parts = [F.lit(p) if i % 2 == 0 else {"feature": feature, "direction": direction}[p] for i, p in enumerate(_FIELD.split(text)) if p or i % 2]
    return F.concat(*parts) if parts else F.lit("")


def reason_text(feature: Column, contribution: Column, value: Column) -> Column:
    """Text for one contribution; "above" or "below" is the sign of the contribution.

    A template is what stands before its value, the value's format, and what stands after it; the number is
    formatted once, by the format its feature asks for.
    """
    direction = F.when(contribution > 0, "above").otherwise("below")

    def choose(pick) -> Column:
        out = None
        for name, template in REASON_TEMPLATES.items():
            out = F.when(feature == name, pick(template)) if out is None else out.when(feature == name, pick(template))
        return out.otherwise(pick(FALLBACK_TEMPLATE))

    spec = lambda t: _VALUE.search(t).group(1)
    number = _number(
        value,
        choose(lambda t: F.lit(int(re.search(r"\d", spec(t)).group()))),
        choose(lambda t: F.lit(spec(t).endswith("%"))),
        choose(lambda t: F.lit(spec(t).startswith("+"))),
    )
    before = choose(lambda t: _filled(_VALUE.split(t)[0], feature, direction))
    after = choose(lambda t: _filled(_VALUE.split(t)[2], feature, direction))
    return F.concat(before, number, after)
