"""Registered queries over the sample tables and the SQL that each must agree with."""
