"""The event-at-a-time model, in plain Python: what the window and aggregate forms must equal."""

from __future__ import annotations


def customers(rows):
    state = {}
    for r in rows:
        cur = state.get(r["customer_id"])
        if cur and cur["last_order_id"] == r["order_id"]:
            continue
        if not cur:
            cur = state[r["customer_id"]] = {"total_orders": 0, "total_spent": 0, "first_order_timestamp": r["timestamp"]}
        cur["total_orders"] += 1
        cur["total_spent"] += round(r["total"] * 100)
        cur["last_order_id"], cur["last_order_timestamp"] = r["order_id"], r["timestamp"]
    return {k: (v["total_orders"], v["total_spent"], v["last_order_id"], v["last_order_timestamp"],
                v["first_order_timestamp"]) for k, v in state.items()}


def ring(rows, size):
    line = []
    for r in rows:
        if all(e["order_id"] != r["order_id"] for e in line):
            line = [r, *line][:size]
    return [e["order_id"] for e in line]


def registry(rows):
    stored, updates = {}, []
    for r in rows:
        old = stored.get(r["order_id"])
        if old is None:
            stored[r["order_id"]] = dict(r, status="accepted", version=1)
        elif (old["status"], old["quantity"], old["total"]) != (r["status"], r["quantity"], r["total"]):
            before = old["status"]
            old["status"], old["version"] = r["status"], old["version"] + 1
            updates.append((r["order_id"], old["version"], before, r["status"]))
    return {k: (v["status"], v["version"], v["quantity"], v["total"]) for k, v in stored.items()}, sorted(updates)
