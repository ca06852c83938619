"""Incident classification, report and plan text (X5-X12, J6 data).

The offline analyst is a rule ladder over the KPI prompt text; the planner
is a playbook lookup. Both are expressed as column expressions (no UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relaywatch.functions.text import first_number, fmt1, named_metric, strip

# ---------------------------------------------------------------------------
# Fixed values. Labels, confidences, evidence sentences, the playbook and the
# report layout must equal the reference application's for results to agree.
# ---------------------------------------------------------------------------

# Classification ladder, in order: (label, confidence, hint, evidence
# sentences). ``{delay}``, ``{prep}`` and ``{cancel}`` stand for the metric
# texts read back from the prompt.
LADDER = [
    ("Kitchen Bottleneck", "91%", "kitchen_delay", [
        "Average prep time has spiked to {prep} (exceeding standard SLA of 20 min).",
        "Preparation delays directly correlate with order queues.",
        "Analysis shows a 42% increase in prep durations compared to the daily average.",
    ]),
    ("Courier Shortage", "89%", "courier_delay", [
        "Delay rate has reached {delay} despite normal kitchen prep times of {prep}.",
        "Courier dispatch queue latency has increased.",
        "Pending delivery assignments have built up.",
    ]),
    ("Weather Surge", "95%", "weather_surge", [
        "Adverse weather conditions detected with high delays ({delay}) and elevated "
        "cancellation rate ({cancel}).",
        "Rider transit speeds have dropped.",
        "Active couriers logged in has decreased.",
    ]),
    ("Staff Shortage", "88%", "staff_shortage", [
        "Average prep time has increased to {prep} and order cancellation rate is {cancel}.",
        "Kitchen stations are operating under capacity.",
        "Order packing and assembly times are severely bottlenecked.",
    ]),
    ("Festival Rush", "90%", "festival_rush", [
        "Order inflow has surged, leading to prep times of {prep} and delay rate of {delay}.",
        "Customer transaction frequency is high.",
        "Peak traffic delays are affecting courier times.",
    ]),
    ("Inventory Shortage", "93%", "inventory_shortage", [
        "Order cancellation rate is high ({cancel}) while average prep time is {prep}.",
        "Multiple menu items are running out of stock.",
        "Automated alerts show raw ingredient deficits.",
    ]),
]
GENERAL = ("General Operational Anomaly", "75%", None, [
    "Elevated delay rate ({delay}) and cancellation rate ({cancel}) detected.",
    "Operational metrics are fluctuating near alert thresholds.",
])

# Metric texts used when the prompt lacks a metric line.
DEFAULT_DELAY_TEXT = "24%"
DEFAULT_PREP_TEXT = "28 min"
DEFAULT_CANCEL_TEXT = "12%"

# Numeric rules attached to ladder steps (strict comparisons, 1-decimal values).
KITCHEN_PREP_OVER = 22.0
COURIER_DELAY_OVER = 20.0
COURIER_PREP_AT_MOST = 20.0
INVENTORY_CANCEL_OVER = 15.0

# Playbook: issue -> (procedure reference, improvement, actions).
PLAYBOOK = [
    ("Kitchen Bottleneck", "SOP-OPS-001 (Kitchen Delay SOP)", "28%", [
        "Add one cook to Station B (Prep/Assembly Line) immediately.",
        "Prioritize high-volume / high-frequency dishes (e.g., standard burgers and simple biryani).",
        "Temporarily pause low-demand/high-prep time items from the digital menu.",
    ]),
    ("Courier Shortage", "SOP-OPS-002 (Courier Delay SOP)", "22%", [
        "Increase delivery payout multiplier to 1.5x for active riders to attract partners.",
        "Route high-priority orders to third-party premium logistics networks.",
        "Automatically stack up to 2 orders per delivery courier going to the same area.",
    ]),
    ("Weather Surge", "SOP-OPS-006 (Weather Surge SOP)", "30%", [
        "Restrict delivery operations to a maximum 2.5km radius from the store.",
        "Enable Weather Surcharge (+30%) payout bonuses for riders.",
        "Transition to double-bag thermal packaging to protect food from rain and heat.",
    ]),
    ("Staff Shortage", "SOP-OPS-003 (Staff Shortage SOP)", "20%", [
        "Re-assign floor staff / front-of-house crew to packing and assembly tables.",
        "Optimize the active menu by suspending dishes that require multiple stations.",
        "Authorize overtime bonuses (+2.0x hourly) for off-duty kitchen staff.",
    ]),
    ("Festival Rush", "SOP-OPS-004 (Festival Rush SOP)", "25%", [
        "Limit order throughput by adding a 5-minute stagger interval on aggregators.",
        "Pre-prep popular high-demand items in batches before rush hours.",
        "Switch active delivery radius to a compact 3km zone.",
    ]),
    ("Inventory Shortage", "SOP-OPS-005 (Inventory Shortage SOP)", "35%", [
        "Mark out-of-stock items as Unavailable on delivery apps.",
        "Offer pre-approved substitutes automatically to customers.",
        "Direct emergency local vendor supply orders for ingredient replenishment.",
    ]),
]
PLAYBOOK_DEFAULT = ("SOP-OPS-General", "10%", [
    "Monitor operational metrics and verify data flows.",
    "Standardize delivery dispatcher assignments.",
    "Ensure backup riders are on standby.",
])
PLAN_RATIONALE = (
    "The corrective actions align with standard operating procedures and target the specific "
    "constraints identified. Execution of these steps will relieve bottleneck congestion and "
    "restore service metrics to baseline levels.")

# Parser defaults.
REPORT_DEFAULT_ISSUE = "General Operational Anomaly"
REPORT_DEFAULT_CONFIDENCE = "75%"
REPORT_DEFAULT_EVIDENCE = "Metrics deviate from normal thresholds."
PLAN_DEFAULT_SOP = "SOP-General"
PLAN_DEFAULT_IMPROVEMENT = "25%"
PLAN_DEFAULT_ACTION = "Activate general incident response protocols."
RECORD_DEFAULT_IMPROVEMENT = 25
RECORD_DEFAULT_CONFIDENCE = 0.90


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# KPI prompt text.
# ---------------------------------------------------------------------------

def kpi_prompt(delay_rate, avg_prep, cancel_rate, score, hint) -> Column:
    """X10 + X11: the analyst's metric text, values to one decimal."""
    return F.concat(
        F.lit("Please analyze these current operational metrics:\n"),
        F.lit("Delay Rate = "), fmt1(_c(delay_rate)), F.lit("%\n"),
        F.lit("Prep Time = "), fmt1(_c(avg_prep)), F.lit(" min\n"),
        F.lit("Cancellation Rate = "), fmt1(_c(cancel_rate)), F.lit("%\n"),
        F.lit("Reliability Score = "), fmt1(_c(score)), F.lit("%\n"),
        F.lit("Incident Mode Hint = "), F.coalesce(_c(hint), F.lit("normal")), F.lit("\n"))


# ---------------------------------------------------------------------------
# Classification.
# ---------------------------------------------------------------------------

def _fill(template: str, delay: Column, prep: Column, cancel: Column) -> Column:
    """Evidence sentence with metric texts substituted (format_string)."""
    cols = {"{delay}": delay, "{prep}": prep, "{cancel}": cancel}
    fmt, order, i = "", [], 0
    while i < len(template):
        for key, col in cols.items():
            if template.startswith(key, i):
                fmt += "%s"
                order.append(col)
                i += len(key)
                break
        else:
            fmt += "%%" if template[i] == "%" else template[i]
            i += 1
    return F.format_string(fmt, *order) if order else F.lit(template)


METRIC_COLS = ("_delay_t", "_prep_t", "_cancel_t")


def with_metric_texts(df, prompt_col: str):
    """X6 + X5 on the prompt: metric texts (with defaults) and their values,
    as columns, so later expressions reference them instead of re-deriving."""
    t = F.col(prompt_col)
    return df.withColumns({
        "_delay_t": F.coalesce(named_metric(t, "Delay Rate"), F.lit(DEFAULT_DELAY_TEXT)),
        "_prep_t": F.coalesce(named_metric(t, "Prep Time"), F.lit(DEFAULT_PREP_TEXT)),
        "_cancel_t": F.coalesce(named_metric(t, "Cancellation Rate"), F.lit(DEFAULT_CANCEL_TEXT)),
        "_low": F.lower(t),
    }).withColumns({
        "_delay_v": first_number("_delay_t"),
        "_prep_v": first_number("_prep_t"),
        "_cancel_v": first_number("_cancel_t"),
    })


def classify_columns(policy: str = "coded") -> Column:
    """X12 over the columns of ``with_metric_texts``: a struct (issue,
    confidence, evidence ARRAY<STRING>).

    ``policy='coded'`` reproduces the ladder as written: each step fires on
    its hint *or* its numeric rule, in order, so numeric rules of earlier
    steps shadow later hints (F8). ``policy='hint_first'`` tries every hint
    before any numeric rule.
    """
    low = F.col("_low")
    delay_t, prep_t, cancel_t = F.col("_delay_t"), F.col("_prep_t"), F.col("_cancel_t")
    delay, prep, cancel = F.col("_delay_v"), F.col("_prep_v"), F.col("_cancel_v")
    numeric = {
        "kitchen_delay": prep > KITCHEN_PREP_OVER,
        "courier_delay": (delay > COURIER_DELAY_OVER) & (prep <= COURIER_PREP_AT_MOST),
        "inventory_shortage": cancel > INVENTORY_CANCEL_OVER,
    }

    def result(step) -> Column:
        label, conf, _, ev = step
        return F.struct(F.lit(label).alias("issue"), F.lit(conf).alias("confidence"),
                        F.array(*[_fill(e, delay_t, prep_t, cancel_t) for e in ev])
                        .alias("evidence"))

    if policy == "coded":
        steps = [((low.contains(s[2]) | numeric[s[2]]) if s[2] in numeric
                  else low.contains(s[2]), s) for s in LADDER]
    elif policy == "hint_first":
        steps = ([(low.contains(s[2]), s) for s in LADDER]
                 + [(numeric[s[2]], s) for s in LADDER if s[2] in numeric])
    else:
        raise ValueError(f"unknown policy {policy!r}")
    expr = None
    for cond, step in steps:
        expr = F.when(cond, result(step)) if expr is None else expr.when(cond, result(step))
    return expr.otherwise(result(GENERAL))


def classify(df, prompt_col: str = "prompt", policy: str = "coded", out_col: str = "cls"):
    """X12 on a frame with a KPI prompt column; adds ``out_col`` (struct)."""
    helpers = [*METRIC_COLS, "_low", "_delay_v", "_prep_v", "_cancel_v"]
    return (with_metric_texts(df, prompt_col)
            .withColumn(out_col, classify_columns(policy)).drop(*helpers))


# ---------------------------------------------------------------------------
# X11: report and plan text; X7 / X8: parse them back.
# ---------------------------------------------------------------------------

def report_text(issue, confidence, evidence) -> Column:
    """X11: the incident report as the analyst writes it."""
    ev = F.array_join(F.transform(_c(evidence), lambda e: F.concat(F.lit("- "), e)), "\n")
    return F.concat(F.lit("### INCIDENT ANALYSIS REPORT\n\n**Issue**: "), _c(issue),
                    F.lit("\n**Confidence**: "), _c(confidence),
                    F.lit("\n\n**Evidence**:\n"), ev,
                    F.lit("\n\n**Status**: Active Anomaly Detected\n"))


def plan_text(sop, improvement, actions) -> Column:
    """X11: the action plan as the planner writes it (numbered actions)."""
    numbered = F.array_join(F.transform(_c(actions), lambda a, i: F.concat(
        (i + 1).cast("string"), F.lit(". "), a)), "\n")
    return F.concat(F.lit("### STRATEGIC ACTION PLAN\n\n**Retrieved SOP**: "), _c(sop),
                    F.lit("\n**Expected Recovery Improvement**: "), _c(improvement),
                    F.lit("\n\n**Recommended Corrective Actions**:\n"), numbered,
                    F.lit("\n\n**Strategic Rationale**:\n"), F.lit(PLAN_RATIONALE), F.lit("\n"))


# Fixed headings of the planner's context.
CONTEXT_REPORT, CONTEXT_SOP, CONTEXT_PAST = (
    "=== INCIDENT REPORT ===", "=== RETRIEVED SOP ===", "=== PAST MEMORY RECORDS ===")
NO_SOP, NO_PAST, NO_CONFIDENCE = (
    "No relevant SOP found.", "No similar past incidents recorded.", "N/A")


def context_text(issue, confidence, evidence, content, past) -> Column:
    """X11: what the planner reads: the parsed report, the retrieved procedure and
    the past incidents (an array of (incident, solution, improvement, confidence)
    structs in rank order)."""
    bullets = F.array_join(F.transform(F.coalesce(_c(evidence), F.array().cast("array<string>")),
                                       lambda e: F.concat(F.lit("- "), e)), "\n")
    records = F.array_join(F.transform(_c(past), lambda p, i: F.concat(
        F.lit("Past Incident "), (i + 1).cast("string"), F.lit(":\n  Incident: "), p["incident"],
        F.lit("\n  Solution Applied: "), p["solution"], F.lit("\n  Improvement: "),
        p["improvement"].cast("string"), F.lit("%\n  Confidence: "),
        p["confidence"].cast("string"), F.lit("\n\n"))), "")
    return F.concat(
        F.lit(f"{CONTEXT_REPORT}\nIssue: "), _c(issue), F.lit("\nConfidence: "),
        F.coalesce(_c(confidence), F.lit(NO_CONFIDENCE)), F.lit("\nEvidence:\n"), bullets,
        F.lit(f"\n\n{CONTEXT_SOP}\n"), F.coalesce(_c(content), F.lit(NO_SOP)),
        F.lit(f"\n\n{CONTEXT_PAST}\n"),
        F.when(F.size(_c(past)) > 0, records).otherwise(F.lit(NO_PAST)),
        F.lit("\n"))


def _field(text: Column, label: str, value_pattern: str = "([^\\n]+)") -> Column:
    found = F.regexp_extract(text, "(?i)" + label + "\\s*[:*]*\\s*" + value_pattern, 1)
    return F.when(found != "", found)


def _clean(c: Column) -> Column:
    return strip(F.regexp_replace(c, "\\*", ""))


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda s: strip(s))


def parse_report(text) -> Column:
    """(issue, confidence, evidence) with the parser's defaults.

    Evidence is every line starting with ``-`` or ``*`` that does not
    mention evidence/issue/confidence, markers stripped; the status line is
    captured too (F11).
    """
    t = _c(text)
    issue = F.coalesce(_clean(_field(t, "Issue")), F.lit(REPORT_DEFAULT_ISSUE))
    conf = F.coalesce(_field(t, "Confidence", "(\\d+%)"), F.lit(REPORT_DEFAULT_CONFIDENCE))
    bullets = F.filter(_lines(t), lambda s: (s.startswith("-") | s.startswith("*"))
                       & ~F.lower(s).rlike("evidence|issue|confidence"))
    items = F.filter(F.transform(bullets, lambda s: strip(F.regexp_replace(
        F.ltrim(s, F.lit("-* ")), "\\*\\*", ""))), lambda s: s != "")
    ev = F.when(F.size(items) > 0, items).otherwise(F.array(F.lit(REPORT_DEFAULT_EVIDENCE)))
    return F.struct(issue.alias("issue"), conf.alias("confidence"), ev.alias("evidence"))


def parse_plan(text) -> Column:
    """(sop, improvement, actions) with the parser's defaults."""
    t = _c(text)
    sop = F.coalesce(_clean(_field(t, "Retrieved SOP")), F.lit(PLAN_DEFAULT_SOP))
    imp = F.coalesce(_clean(_field(t, "Expected Recovery Improvement")),
                     F.lit(PLAN_DEFAULT_IMPROVEMENT))
    acts = F.filter(F.transform(
        F.filter(_lines(t), lambda s: s.rlike("^\\d+\\.\\s*.+$")),
        lambda s: strip(F.regexp_replace(F.regexp_extract(s, "^\\d+\\.\\s*(.+)$", 1),
                                          "\\*\\*", ""))), lambda s: s != "")
    acts = F.when(F.size(acts) > 0, acts).otherwise(F.array(F.lit(PLAN_DEFAULT_ACTION)))
    return F.struct(sop.alias("sop"), imp.alias("improvement"), acts.alias("actions"))


def improvement_value(improvement) -> Column:
    """X5 (digits): integer improvement, default 25."""
    return first_number(_c(improvement), RECORD_DEFAULT_IMPROVEMENT, digits_only=True).cast("int")


def confidence_value(confidence) -> Column:
    """X5 (digits): confidence as a fraction, default 0.90."""
    found = F.regexp_extract(_c(confidence), "(\\d+)", 1)
    return F.coalesce(F.when(found != "", found).try_cast("double") / 100.0,
                      F.lit(RECORD_DEFAULT_CONFIDENCE))
