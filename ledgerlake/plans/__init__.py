"""Logical plans for the silver layer, gold marts and dashboard queries."""
