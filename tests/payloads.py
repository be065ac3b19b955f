"""Golden landing documents: invented values in the payload shape, and edge cases."""

import copy
import json


def money(amount="731.58", currency="EUR"):
    return {"amount": amount, "currency": currency}


def item(tid, client="acct-7f3", **over):
    it = {
        "clientId": client,
        "investimentId": "fund-22",
        "transactionId": tid,
        "type": "OUT",
        "transactionType": "REDEMPTION",
        "transactionTypeAdditionalInfo": "partial",
        "transactionConversionDate": "2024-09-17",
        "transactionQuotaPrice": money(),
        "transactionQuotaQuantity": "8.12",
        "transactionValue": money(),
        "transactionGrossValue": money(),
        "incomeTax": money(),
        "financialTransactionTax": money(),
        "transactionExitFee": money(),
        "transactionNetValue": money(),
    }
    it.update(over)
    return it


LINKS = {k: f"https://feeds.invalid/tx?rel={k}" for k in ("self", "first", "prev", "next")}
META = {"requestDateTime": "2024-09-18T23:05:41Z"}


def doc(*items):
    return {"data": list(items), "links": copy.deepcopy(LINKS), "meta": dict(META)}


MALFORMED = json.dumps(doc(item("cut")), indent=1)[:97]  # a document cut off in the middle of an upload

# name → (file text, bronze rows, silver rows, quarantine rows)
GOLDENS = {
    "ok": (json.dumps(doc(item("ok")), indent=2), 1, 1, 0),
    "empty_key": (json.dumps(doc(item("empty_key", client=""))), 1, 0, 1),
    "malformed": (MALFORMED, 1, 0, 1),
    "empty_data": (json.dumps({"data": [], "meta": META}), 1, 0, 1),
    "no_data": (json.dumps({"meta": META}), 1, 0, 1),
    "null_key": (json.dumps({"data": [{k: None for k in item("x")}]}), 1, 0, 1),
    "object_data": (json.dumps({"data": item("object_data")}), 1, 0, 1),
    "scalar_money": (json.dumps(doc(item("scalar_money", transactionExitFee="12.5"))), 1, 1, 0),
    "number_amount": (json.dumps(doc(item("number_amount", transactionValue={"amount": 731.58, "currency": "EUR"}))), 1, 1, 0),
    "top_array": (json.dumps([doc(item("top_array_1")), doc(item("top_array_2"))]), 2, 2, 0),
    "blank_key": (json.dumps(doc(item("blank_key", client=" "))), 1, 1, 0),
    "bad_date": (json.dumps(doc(item("bad_date", transactionConversionDate="2024-02-30"))), 1, 1, 0),
    "bad_amount": (json.dumps(doc(item("bad_amount", transactionValue=money("7,31.58")))), 1, 1, 0),
    "dup_in_file": (
        json.dumps(doc(item("dup_in_file", transactionValue=money("1.00")), item("dup_in_file", transactionValue=money("2.00")))),
        2, 1, 0,
    ),
    "same_key_a": (json.dumps(doc(item("same_key", transactionValue=money("10.00")))), 1, 1, 0),
    "same_key_b": (json.dumps(doc(item("same_key", transactionValue=money("20.00")))), 1, 0, 0),
}


def write_goldens(folder, names=None):
    import os

    os.makedirs(folder, exist_ok=True)
    for name, (text, *_rest) in GOLDENS.items():
        if names is None or name in names:
            with open(os.path.join(folder, f"{name}.json"), "w") as f:
                f.write(text)
