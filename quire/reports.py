"""Reports for people, from totals and the few pages at the top of a ranking."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Mapping, Sequence

# What reports call the first level.
LEVEL_NAMES = {"strict": "strict (raw, unnormalised)", "diacritic_insensitive": "without diacritics", "skeleton": "skeleton"}
METRIC_NAMES = {"cer": "CER", "wer": "WER", "exact_match_rate": "exact match", "hallucination_rate": "hallucination rate", "false_refusal_rate": "false refusal rate"}
#: Differing places of a page that are listed.
DIFFERENCES = 40


def number(x: float | None, places: int = 4) -> str:
    return "—" if x is None else f"{x:.{places}f}"


def percent(x: float | None) -> str:
    return "—" if x is None else f"{100 * x:.2f}%"


def table(head: Sequence[str], rows: Sequence[Sequence[object]]) -> list[str]:
    line = lambda cells: "| " + " | ".join(str(c).replace("|", "\\|") for c in cells) + " |"
    return [line(head), "|" + "---|" * len(head), *map(line, rows), ""]


def _contract(c: Mapping) -> list[str]:
    rows = [
        ("refused, rightly", c["correct_refusal"], ""),
        ("hallucinated", c["hallucination"], f"{percent(c['hallucination_rate'])} of {c['probe_pages']} unreadable pages"),
        ("refused, wrongly", c["false_refusal"], f"{percent(c['false_refusal_rate'])} of {c['legible_pages']} legible pages"),
    ]
    return ["### Refusals", "", *table(("What happened", "Pages", "Rate"), rows)]


def _breakdown(b: Mapping) -> list[str]:
    rows = [(i, f"{r['key']}{' (worst)' if i == 1 else ''}", r["pages"], number(r["cer_micro"]), number(r["cer_macro"]), number(r["wer_micro"]), percent(r["exact_match_rate"])) for i, r in enumerate(b["rows"], 1)]
    note = [] if b["is_partition"] else ["Pages with several values are in several rows, pages without one in none.", ""]
    return [f"#### {b['dimension']}", "", *note, *table(("", "Value", "Pages", "CER (micro)", "CER (macro)", "WER (micro)", "Exact"), rows)]


def summary_markdown(summary: Mapping) -> str:
    out = [f"# {summary['model_version']}", "", f"Run `{summary['run_id']}`, policy {summary['policy']['policy_version']}, engine {summary['tool_version']}.", "", "The first figure of each split is strict. Splits are never added up.", ""]
    for s in summary["splits"]:
        out += [f"## {s['split']}", "", f"{s['pages']} pages, {s['scored_pages']} of them scored.", ""]
        if s["headline"] is None:
            out += ["No page here has text to measure against, so there is no error rate (which is not an error rate of zero).", "", *_contract(s["contract"])]
        else:
            h, o = s["headline"], s["order"]
            out += [f"**CER {number(h['cer'])}**, WER {number(h['wer'])}, exact match {percent(h['exact_match_rate'])}", ""]
            out += table(("Level", "CER (micro)", "CER (macro)", "WER (micro)", "WER (macro)", "Exact"), [(LEVEL_NAMES[k], number(m["cer"]["micro"]), number(m["cer"]["macro"]), number(m["wer"]["micro"]), number(m["wer"]["macro"]), percent(m["exact_match_rate"])) for k, m in s["metrics"].items()])
            out += ["### Reading order", "", f"CER {number(h['cer'])} as produced, {number(o['order_corrected_cer_micro'])} with lines in the reference's order; {percent(o['reading_order_accuracy'])} of line pairs in order; {o['pages_without_order_signal']} pages say nothing about order.", ""]
            out += _contract(s["contract"])
        if any(s["flags"].values()):
            out += ["### Flags", "", *table(("Flag", "Pages"), [(k, v) for k, v in sorted(s["flags"].items()) if v])]
        if any(b["rows"] for b in s["breakdowns"]):
            out += ["### Breakdowns", "", *(x for b in s["breakdowns"] if b["rows"] for x in _breakdown(b))]
    for note in summary["notes"]:
        out += [f"> {note}", ""]
    return "\n".join(out)


def comparison_markdown(c: Mapping) -> str:
    out = [f"# {c['baseline_model_version']} → {c['candidate_model_version']}: {c['verdict']}", "", *(f"- {r}" for r in c["verdict_reasons"]), ""]
    out += [f"Runs `{c['baseline_run_id']}` and `{c['candidate_run_id']}`, policy {c['policy_version']}, primary split {c['primary_split']}; {c['regression_count']} pages worse, {c['improvement_count']} better.", ""]
    for s in c["splits"]:
        out += [f"## {s['split']}", ""]
        rows = [(METRIC_NAMES[m["metric"]], number(m["baseline"]), number(m["candidate"]), f"{m['delta']:+.4f}", m["direction"]) for m in s["metrics"]]
        out += table(("Metric", "Baseline", "Candidate", "Change", ""), rows) if rows else ["No metric has a value on both sides.", ""]
    if c["bootstrap"]:
        b = c["bootstrap"][0]
        rows = [(x["split"], f"{x['delta_cer']:+.4f}", f"{x['ci_low']:+.4f} to {x['ci_high']:+.4f}", "yes: may be chance" if x["ci_low"] <= 0.0 <= x["ci_high"] else "no") for x in c["bootstrap"]]
        out += ["## Mean change of CER", "", f"{b['confidence']:.0%} intervals of {b['resamples']} paired resamples, seed {b['seed']}.", "", *table(("Split", "Mean", "Interval", "Contains zero"), rows)]
    for key, title in (("regressions", "Worse"), ("improvements", "Better")):
        if c[key]:
            out += [f"## {title}: {len(c[key])} of {c[key[:-1] + '_count']}", "", *table(("Page", "Split", "Baseline", "Candidate", "Change", "Outcome"), [(d["page_id"], d["split"], number(d["baseline_cer"]), number(d["candidate_cer"]), f"{d['delta_cer']:+.4f}", d["outcome_changed"] or "") for d in c[key]])]
    return "\n".join(out)


def _named(c: str | None) -> str:
    if c is None:
        return "(end)"
    return f"U+{ord(c):04X} {'LINE FEED' if c == chr(10) else unicodedata.name(c, 'unnamed')}"


def codepoint_differences(reference: str, prediction: str, most: int = DIFFERENCES) -> list[str]:
    """Place by place, what stands in the reference and what in the prediction."""
    at = lambda s, i: s[i] if i < len(s) else None
    places = [i for i in range(max(len(reference), len(prediction))) if at(reference, i) != at(prediction, i)]
    out = [f"{i}: {_named(at(reference, i))} / {_named(at(prediction, i))}" for i in places[:most]]
    return out + ([f"{len(places) - most} more places differ"] if len(places) > most else [])


def worst_markdown(pages: Sequence[Mapping]) -> str:
    """pages: rows with page_id, split, cer, wer, outcome, flags, reference and prediction, worst first."""
    out = ["# Worst pages", "", "By strict CER. Code points are compared place by place, not aligned.", ""]
    if not pages:
        out.append("No page was scored.")
    for i, p in enumerate(pages, 1):
        out += [f"## {i}. {p['page_id']}", "", f"{p['split']}, CER {number(p['cer'])}, WER {number(p['wer'])}, {p['outcome']}{', ' + ', '.join(p['flags']) if p['flags'] else ''}", ""]
        out += ["Reference:", "", *("    " + x for x in p["reference"].split("\n")), "", "Prediction:", "", *("    " + x for x in p["prediction"].split("\n")), "", *(f"- {d}" for d in codepoint_differences(p["reference"], p["prediction"])), ""]
    return "\n".join(out)


def page(title: str, body: str, direction: str = "ltr") -> str:
    style = "body{font-family:sans-serif;margin:2em}table{border-collapse:collapse;width:100%}td,th{border:1px solid #999;padding:.4em;vertical-align:top}.text{white-space:pre-wrap;width:45%}"
    return f'<!DOCTYPE html>\n<html lang="en"><head><meta charset="utf-8"><title>{html.escape(title)}</title><style>{style}</style></head><body dir="{direction}">\n{body}\n</body></html>\n'


def worst_html(pages: Sequence[Mapping]) -> str:
    """References beside predictions, right to left; nothing is loaded from elsewhere."""
    esc = lambda x: html.escape(str(x), quote=True)
    rows = "\n".join(f'<tr><td dir="ltr">{esc(p["page_id"])}<br>{esc(p["split"])}<br>CER {number(p["cer"])}<br>{esc(", ".join(p["flags"]))}</td><td class="text" dir="auto">{esc(p["reference"])}</td><td class="text" dir="auto">{esc(p["prediction"])}</td></tr>' for p in pages)
    return page("Worst pages", f"<h1>Worst pages</h1>\n<table><tr><th>Page</th><th>Reference</th><th>Prediction</th></tr>\n{rows}\n</table>", "rtl")


def recut_markdown(rows: Sequence[Mapping]) -> str:
    return "\n".join(["# Worst pages", "", *table(("", "Page", "Split", "CER", "WER", "Outcome", "Flags"), [(i, r["page_id"], r["split"], number(r["cer"]), number(r["wer"]), r["outcome"], ", ".join(r["flags"])) for i, r in enumerate(rows, 1)])])


def as_html(title: str, markdown: str) -> str:
    return page(title, f"<pre>{html.escape(markdown, quote=True)}</pre>")
