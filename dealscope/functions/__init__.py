"""Column expressions shared by staging and the marts. All of them stay in the JVM."""
