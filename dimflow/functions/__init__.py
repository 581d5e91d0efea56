"""Column expressions: validation rules, loan arithmetic, change detection."""
