"""Column types of the engine's tables and the fixed vocabularies of queries."""

from __future__ import annotations

STEP = "struct<step_index:int,role:string,content:string,tool_call_name:string,tool_call_args:string,tool_result:string>"
SPAN = "struct<start_step:int,end_step:int>"
VERDICT = f"struct<match:boolean,confidence:double,spans:array<{SPAN}>,reasoning:string,evidence_step:int,criteria_hit:array<string>>"
FILTERS = "struct<languages:array<string>,tools_used:array<string>,has_verification_step:boolean>"
RUBRIC = "struct<positive_criteria:array<string>,negative_criteria:array<string>,decisive_evidence:string,capability_kind:string>"
EVIDENCE = "struct<trajectory_id:string,evidence_steps:array<int>,observed_failure:string>"
SUB_PROBLEM = (
    "struct<id:string,origin:string,parent_id:string,raw_text:string,failure_summary:string,target_capability:array<string>,"
    "trajectory_signal:string,hyde_positive:array<string>,keywords:array<string>,"
    f"structured_filters:{FILTERS},confidence:double,route:string,rubric:{RUBRIC},failure_evidence:{EVIDENCE}>"
)
PROBLEM_SPEC = f"raw_input string, domain string, sub_problems array<{SUB_PROBLEM}>"
LABEL = (
    "struct<label:string,parent:string,new_root:boolean,description:string,keywords:array<string>,"
    "description_embedding:array<float>,taxonomy_extension:boolean,created_at:string>"
)
TAXONOMY = f"version string, updated_at string, labels array<{LABEL}>"

# What query filters and drops may say.
LANGUAGES = ("python", "cpp", "java", "javascript", "go", "bash", "html", "other")
TOOLS_USED = ("Bash", "Read", "Write", "Edit", "Glob", "Grep", "WebFetch", "WebSearch", "Task", "TodoWrite", "NotebookEdit", "other")
DROP_REASONS = ("ambiguous", "not_applicable", "label_diverged", "no_trajectory_evidence", "other")
CAPABILITY_KINDS = ("presence", "avoidance", "recovery")
ROLES = ("user", "assistant", "tool", "system")
