"""Ready-made jobs: functions from tables to tables.

Inputs have snake_case headers unless a docstring says otherwise; results carry the headers
their reports use.
"""
