"""Messages for the language model: the compiler's calls and the judge's question."""

from __future__ import annotations

from collections.abc import Callable

from tracequarry import schemas

Messages = list[dict[str, str]]

# What each call asks for.
DECOMPOSE = (
    "Split the complaint about an agent into independent sub-problems. Keep each one's own words in raw_text and say in failure_summary, in one "
    'sentence, what went wrong. Answer with JSON only: {"sub_problems": [{"id", "raw_text", "failure_summary"}]}.'
)
LABEL = (
    "For each sub-problem give: id, target_capability (1 to 3 labels), trajectory_signal, hyde_positive (2 or 3 snippets of a log that shows the "
    "capability), keywords, structured_filters (languages, tools_used, has_verification_step or null), confidence (0 to 1), route (pass or drop), "
    "drop_reason for a drop, label_proposals, and for a pass a rubric (capability_kind, positive_criteria, negative_criteria, decisive_evidence). "
    'Answer with JSON only: {"results": [...]}.'
)
KNOWN_LABELS = "Use these labels where they fit, and propose a new one (taxonomy_extension: true) where none does:"
NO_LABELS = "There are no labels yet: propose each one (taxonomy_extension: true)."
EVIDENCE = "A failed run is given below. Add failure_evidence (trajectory_id, evidence_steps, observed_failure) where it shows the failure; use the drop_reason no_trajectory_evidence where it doesn't."
CLARIFY = (
    "These sub-problems were dropped as ambiguous. Write up to four readings of each, with ids of their own. "
    'Answer with JSON only: [{"original_id", "clarified": [{"id", "raw_text", "failure_summary"}]}].'
)
RELABEL = "These are readings of ambiguous sub-problems: give no drop_reason and ask for nothing more; leave out what you are less than 0.8 sure of."
JUDGE = (
    "Decide for each slice of an agent's log whether it shows the capability. Answer with a JSON array, an element for each slice in order: "
    '{"match", "confidence", "spans": [{"start_step", "end_step"}], "reasoning", "evidence_step", "criteria_hit"}.'
)


def _chat(system: list[str], user: list[str]) -> Messages:
    return [{"role": "system", "content": "\n\n".join(system)}, {"role": "user", "content": "\n".join(user)}]


def _items(items: list[dict]) -> list[str]:
    out = []
    for x in items:
        out += [f"- id: {x['id']}", f"  raw_text: {x.get('raw_text', '')}", f"  failure_summary: {x.get('failure_summary', '')}"]
        if x.get("target_capability"):
            out.append(f"  labels so far: {', '.join(x['target_capability'])}")
    return out


def messages(call: str, payload: dict, taxonomy: str = "") -> Messages:
    """Messages of a compiler call. A failed run's evidence goes into labelling only, never into relabelling."""
    if call == "decompose":
        return _chat([DECOMPOSE], [payload["question"]])
    if call == "clarify":
        return _chat([CLARIFY], _items(payload["items"]))
    words = [f"languages: {', '.join(sorted(schemas.LANGUAGES))}", f"tools_used: {', '.join(sorted(schemas.TOOLS_USED))}"]
    system = [LABEL, "\n".join(words), f"{KNOWN_LABELS}\n{taxonomy}" if taxonomy else NO_LABELS]
    if call == "relabel":
        system.append(RELABEL)
    elif payload.get("evidence") is not None:
        system.append(f"{EVIDENCE}\n{payload['evidence']}")
    return _chat(system, _items(payload["items"]))


def asking(model: Callable[[Messages], "str | None"], taxonomy: str = "") -> Callable[[str, dict], "str | None"]:
    """What ``compiling.Compiler`` calls, on top of a chat model."""
    return lambda call, payload: model(messages(call, payload, taxonomy))


def judge_prompt(problem: dict, summaries: list[str]) -> str:
    """The judge's question: capability, signal, the rubric's parts that are there, and the slices."""
    out = [f"capability: {', '.join(problem.get('target_capability') or [])}", f"signal: {problem.get('trajectory_signal') or ''}"]
    rubric = problem.get("rubric")
    if rubric is not None:
        out.append("rubric:")
        if rubric.get("capability_kind"):
            out.append(f"  kind: {rubric['capability_kind']}")
        for name in ("positive_criteria", "negative_criteria"):
            out += [f"  {name.split('_')[0]}: {c}" for c in rubric.get(name) or []]
        if rubric.get("decisive_evidence"):
            out.append(f"  decisive: {rubric['decisive_evidence']}")
    for i, summary in enumerate(summaries, 1):
        out += ["", f"slice {i}:", summary]
    return "\n".join([*out, "", f"Judge all {len(summaries)} slices."])


def judging(model: Callable[[Messages], "str | None"]) -> Callable[[dict, list[str]], "str | None"]:
    """What ``operators.judging.judge`` calls, on top of a chat model."""
    return lambda problem, summaries: model([{"role": "system", "content": JUDGE}, {"role": "user", "content": judge_prompt(problem, summaries)}])
