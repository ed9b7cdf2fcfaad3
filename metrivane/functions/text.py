"""Report sentences, identifiers and action lists as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metrivane.functions.scalars import _c, percent_text

# Actions by KPI and by the words found in the cause text.  The first
# entry whose words all occur applies; an entry without words always applies.
ACTION_RULES = {
    "conversion_rate": [
        (
            ("Mobile", "Safari"),
            (
                "Review mobile Safari checkout/session flow.",
                "Check recent frontend releases affecting mobile Safari users.",
                "Compare funnel steps for Mobile Safari against Chrome.",
            ),
        ),
        ((), ("Review conversion funnel changes for the affected segment.",)),
    ],
    "latency_ms": [
        (
            (),
            (
                "Inspect regional latency, CDN routing, and browser-specific performance logs.",
                "Check backend response times and recent deployment windows.",
                "Compare Chrome performance against Safari and Firefox for the same region.",
            ),
        ),
    ],
    "revenue_per_session": [
        (
            ("Paid Search", "Enterprise"),
            (
                "Review paid-search landing page quality and enterprise account purchase flow.",
                "Check campaign targeting, discount logic, and high-value segment conversion path.",
                "Compare Enterprise revenue per session against SMB and Mid-Market segments.",
            ),
        ),
        (
            ("Paid Search",),
            (
                "Review paid-search landing page quality for the affected segment.",
                "Check campaign targeting, landing page routing, and paid-search tracking.",
                "Compare paid-search revenue per session against Organic and Email traffic.",
            ),
        ),
        (
            ("Enterprise",),
            (
                "Review enterprise account purchase flow and pricing logic.",
                "Check discount logic and high-value segment conversion path.",
                "Compare Enterprise revenue per session against SMB and Mid-Market segments.",
            ),
        ),
        (
            (),
            (
                "Review revenue per session drivers for the affected segment.",
                "Check product mix, checkout path, pricing, and tracking for the suspected dimensions.",
                "Compare affected segment revenue per session against adjacent segments.",
            ),
        ),
    ],
}

# Investigation hints by (metric, device_type, region, browser).
INVESTIGATIONS = {
    ("conversion_rate", "Mobile", "EMEA", "Safari"): (
        "Check mobile Safari checkout flow, consent/tracking changes, or regional deployment issue."
    ),
    ("ctr", "Desktop", "NA", "Chrome"): (
        "Check campaign creative, homepage module changes, or tracking implementation."
    ),
    ("latency_ms", "Mobile", "APAC", "Firefox"): (
        "Check regional latency, CDN routing, or frontend performance regression."
    ),
}
INVESTIGATION_DEFAULT = (
    "Review the affected segment for recent product, tracking, campaign, or performance changes."
)


def rules_for(kpi: Column, cause_text: Column, rules: dict = ACTION_RULES) -> Column:
    """The actions the rule table gives for a KPI and its cause text, as an array."""
    other = F.array(
        F.format_string("Review recent product, tracking, and campaign changes affecting %s.", kpi)
    )
    expr = None
    for name, branches in rules.items():
        for words, actions in branches:
            cond = kpi == name
            for w in words:
                cond = cond & cause_text.contains(w)
            value = F.array(*[F.lit(a) for a in actions])
            expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return other if expr is None else expr.otherwise(other)


def actions_for(kpi: Column, cause_text: Column, cause_actions: Column, n: int) -> Column:
    """Rule actions, then the causes' own actions not yet listed, first ``n``."""
    return F.slice(F.array_union(rules_for(kpi, cause_text), cause_actions), 1, n)


def cause_action(kpi, dimension_type, dimension_value) -> Column:
    return F.format_string(
        "Review %s drivers for %s = %s; "
        "check recent releases, tracking changes, campaign mix, and operational issues.",
        _c(kpi),
        _c(dimension_type),
        _c(dimension_value),
    )


def _movement(direction: Column) -> Column:
    return F.when(direction == "higher_is_bad", "excess latency").otherwise("measured degradation")


def cause_statement(kpi, date, dimension_value, share, direction: Column) -> Column:
    verb = F.when(direction == "higher_is_bad", "accounted for").otherwise("contributed")
    return F.format_string(
        "For %s on %s, %s %s %s%% of %s.",
        _c(kpi),
        _c(date).cast("string"),
        _c(dimension_value),
        verb,
        percent_text(share),
        _movement(direction),
    )


def executive_summary(date, kpi, severity, detector, cause, share, direction: Column, action: Column) -> Column:
    return F.format_string(
        "On %s, %s showed a %s issue. The %s detector flagged abnormal movement, and RCA identified "
        "%s as the dominant contributor, explaining %s%% of %s. Recommended next step: %s",
        _c(date).cast("string"),
        _c(kpi),
        F.lower(_c(severity)),
        _c(detector),
        _c(cause),
        percent_text(share),
        _movement(direction),
        action,
    )


def incident_id(date, kpi, detector) -> Column:
    def shout(c):
        return F.replace(F.upper(_c(c)), F.lit("_"), F.lit("-"))

    return F.concat(
        F.lit("INC-"), F.date_format(_c(date), "yyyyMMdd"), F.lit("-"), shout(kpi), F.lit("-"), shout(detector)
    )


def investigation(metric: str, device, region, browser) -> Column:
    expr = F.lit(INVESTIGATION_DEFAULT)
    for (m, d, r, b), hint in INVESTIGATIONS.items():
        if m == metric:
            expr = F.when((_c(device) == d) & (_c(region) == r) & (_c(browser) == b), hint).otherwise(expr)
    return expr


def z_band(z) -> Column:
    """Fixed bands of the metric digest: 5 Critical, 3 High, 2 Medium."""
    a = F.abs(_c(z))
    return F.when(a >= 5, "Critical").when(a >= 3, "High").when(a >= 2, "Medium").otherwise("Normal")
