"""DataFrame → DataFrame operators, grouped by corpus-preparation step."""
