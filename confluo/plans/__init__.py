"""Plan-level building blocks: tables in the shared folder, components, salting."""
