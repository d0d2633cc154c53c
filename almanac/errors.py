class ContractError(ValueError):
    """A frame does not satisfy a schema contract (raised on the driver from
    schema metadata only; no data is collected)."""


class ValidationError(ValueError):
    """A data check failed; ``violations`` is the offending DataFrame."""

    def __init__(self, message, violations=None):
        super().__init__(message)
        self.violations = violations
