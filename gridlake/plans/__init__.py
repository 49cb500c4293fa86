"""Whole-stage plans: the daily chain and the registered queries."""
