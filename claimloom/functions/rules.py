"""Validity rules of a claim as SQL conditions, used by the checks on raw rows and by cleaning."""

# Accepted range of days_supply and of the batch size.
DAYS_SUPPLY_RANGE = (1, 365)
ROW_COUNT_RANGE = (1_000, 10_000_000)
# Accepted amounts unless another range is given: below a cent or above this, exact sums could lose digits or overflow.
AMOUNT_RANGE = (0.01, 1e12)
AmountRange = tuple[float, float]


def positive(column: str) -> str:
    """Positive and finite. NaN sorts above infinity in Spark, so the upper bound removes it too."""
    return f"({column} > 0 AND {column} < double('Infinity'))"


def within(column: str, bounds: tuple) -> str:
    """Both ends included. NaN, which sorts above infinity, is outside."""
    return f"({column} BETWEEN {bounds[0]} AND {bounds[1]})"


def one_of(column: str, values: tuple[str, ...]) -> str:
    """Membership; nothing is a member of an empty set."""
    quoted = ", ".join("'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" for value in values)
    return f"({column} IN ({quoted}))" if values else "false"


def violated(rule: str) -> str:
    """True where the rule is false or unknown."""
    return f"(NOT coalesce({rule}, false))"


def amount_within(amounts: AmountRange) -> str:
    """Both ends included; compared as doubles."""
    low, high = (f"double('{float(bound)!r}')" for bound in amounts)
    return within("claim_amount", (low, high))


def acceptance(amounts: AmountRange = AMOUNT_RANGE) -> dict[str, str]:
    """Rules a de-duplicated claim must pass, by the name given as reject reason."""
    return {
        "claim_amount": amount_within(amounts),
        "quantity": positive("quantity"),
        "days_supply": within("days_supply", DAYS_SUPPLY_RANGE),
    }
