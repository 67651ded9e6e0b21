"""PySpark library for preparing, scoring and comparing tutoring data at scale."""
