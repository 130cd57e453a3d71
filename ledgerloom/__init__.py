"""Retail lakehouse operators: plain DataFrame -> DataFrame functions."""
