"""Intake and data quality for prepared tabular files, on Spark."""

from gridgate.config import IntakeConfig
from gridgate.errors import (
    ConfigurationError, DataValidationError, HeaderError, IntakeError, SourceError, TemplateError,
    UnsupportedTypeError)
from gridgate.functions.rules import check, register_rule, rule_for
from gridgate.operators.contract import ColumnSpec, Contract
from gridgate.operators.validate import apply_contract, violations
from gridgate.plans.load import Outcome, run_load
from gridgate.session import prepare

__all__ = [
    "ColumnSpec", "ConfigurationError", "Contract", "DataValidationError", "HeaderError", "IntakeConfig",
    "IntakeError", "Outcome", "SourceError", "TemplateError", "UnsupportedTypeError", "apply_contract", "check",
    "prepare", "register_rule", "rule_for", "run_load", "violations"]
