"""Payment records as tests need them, and the rows of a result."""

import json


def party(ident, name="Ann", **changes):
    fields = {
        "id": ident,
        "username": f"{name}-{ident}",
        "firstname": name,
        "lastname": "Lee",
        "picture": f"http://pics/{ident}",
    }
    fields.update(changes)
    return {k: v for k, v in fields.items() if v is not ...}


def payment(sender="7", receiver="9", at="2017-01-05T10:00:00Z", **changes):
    record = {
        "payment_id": 1,
        "created_time": at,
        "actor": party(sender),
        "transactions": [{"target": party(receiver)}],
        "amount_cents": 250,
    }
    record.update(changes)
    return {k: v for k, v in record.items() if v is not ...}


def line(*args, **changes):
    return json.dumps(payment(*args, **changes))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
