"""Job parameters. The original jobs read a JSON string of conditions from a
properties file; here the same JSON becomes plain keyword arguments of the runners."""

from __future__ import annotations

import json

# Condition keys of the original jobs -> runner argument names (fixed values).
CONDITION_KEYS = {"startDate": "start", "endDate": "end", "targetPageFlow": "target_pages"}


def job_params(condition_json: str) -> dict[str, str]:
    """``'{"startDate": "2018-11-26", "targetPageFlow": "1,2,3"}'`` ->
    ``{"start": "2018-11-26", "target_pages": "1,2,3"}``. Unknown keys are dropped;
    a missing or null key means no bound (the runners' default)."""
    raw = json.loads(condition_json) if condition_json else {}
    return {arg: raw[key] for key, arg in CONDITION_KEYS.items() if raw.get(key) is not None}
