"""Compositions over the operators: warehouse loads, calendar, plan/fact, driver checks."""
