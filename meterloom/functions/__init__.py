"""Column expressions: calendar parts, tariff bill, verdict labels, safe arithmetic."""
