"""The small labelled table of the extraction tree: short pages whose main blocks begin with the mark.

Written by hand for this purpose: articles with the usual things around
them, marked up in the usual ways (semantic tags, named containers, neither).
"""

MAIN_MARK = "§"

_LONG = "The river rose during the night and by morning the lower road was under water, so the school stayed closed and the bus took the long way round."
_MID = "Nobody in the village could remember a spring with so much rain."
_SHORT = "It was over."

LABELLED_PAGES = (
    # semantic tags
    f"<body><header><a href=/>Daily</a> News of the valley</header><nav><ul><li><a href=/a>Home</a><li><a href=/b>Sport</a><li><a href=/c>Weather</a></ul></nav>"
    f"<main><article><h1>§ High water</h1><p>§ {_LONG}</p><p>§ {_MID}</p><p>§ {_SHORT}</p><ul><li>§ Bring boots</li><li>§ Keep dry</li></ul></article></main>"
    f"<aside><h3>More</h3><p>Read our guide to the best walks in the hills this summer, with maps and tips.</p><ul><li><a href=/x>Ten walks near the lake</a></ul></aside>"
    f"<footer>© Valley News. All rights reserved. <a href=/i>Imprint</a></footer></body>",
    f"<body><nav><a href=/1>One</a> <a href=/2>Two</a></nav><div class=ad>Buy new boots today, they never leak.</div><article><h1>§ Boots</h1><p>§ {_MID}<p>§ {_LONG}"
    f"<aside>Also read what the shoemaker told us last week about leather.</aside><p>§ {_SHORT}</article><footer>Contact and terms of the site.</footer></body>",
    # named containers
    f"<body><div id=top-menu><a href=/>Start</a> <a href=/n>News</a></div><div class='cookie-notice'><p>We use cookies to make this site better for you. Do you agree with that?</p></div>"
    f"<div class=post-content><h2>§ A wet spring</h2><p>§ {_LONG}</p><p>§ See the <a href=/m>map of the flood</a> for details of the roads.</p><p>§ {_MID}</p></div>"
    f"<div class=sidebar><p>Our newsletter brings you the news of the week every Friday morning at seven.</p></div>"
    f"<section id=comments><h3>2 comments</h3><div class=comment><p>I have lived here for forty years and I can tell you that this is nothing new at all.</p></div>"
    f"<div class=comment><p>Thanks for this.</p></div></section><div id=footer>Copyright of the paper</div></body>",
    f"<body><form action=/s><label>Search</label><input name=q></form><article><p>§ {_SHORT}</p><p>§ {_LONG}</p><p>§ {_LONG}</p>"
    f"<form><p>Leave your address and we will write to you when something new appears on this page.</p></form><p>§ Wet.</p></article><div class='related-posts'><a href=/q>The bridge is closed</a><p>What the mayor said about the old bridge.</p></div></body>",
    # no containers: only words and links can tell
    f"<body><p><a href=/>Home</a> | <a href=/n>News</a> | <a href=/s>Sport</a></p><h1>§ The valley</h1><p>§ {_LONG}</p><p>§ {_MID} {_MID}</p><p>§ {_LONG} {_SHORT}</p><p><a href=/1>Older</a> <a href=/2>Newer</a></p><p>© the paper</p></body>",
    f"<body><table><tr><td><a href=/a>Roads</a></td><td><a href=/b>Trains</a></td></tr></table><div>§ {_LONG} {_LONG}</div><div>§ {_MID} {_LONG}</div><div>§ {_LONG}</div><div>Imprint</div></body>",
    f"<body><div><a href=/1>First story of the day</a></div><div><a href=/2>Second story of the day</a></div><div><a href=/3>Third story of the day</a></div><div>§ {_LONG} {_MID}</div><div>§ {_MID} {_LONG}</div><div><a href=/z>To the top</a></div></body>",
    f"<body><ul><li><a href=/1>Cars</a><li><a href=/2>Boats</a></ul><p>§ {_MID} {_MID} {_MID}</p><p>§ {_LONG} <a href=/r>The report</a> has more.</p><p>§ {_LONG}</p><p>Share</p><p><a href=/t>Terms</a></p></body>",
    # teasers, hidden parts, adverts within the article
    f"<body><div class=wrap><main><h1>§ Night</h1><div class='advert'><p>The best umbrellas of the year, now at half the price in every shop.</p></div><p>§ {_LONG}</p>"
    f"<div style='display: none'>Please turn on scripts to read on.</div><p>§ {_MID}</p><blockquote>§ {_SHORT}</blockquote></main><div class=teaser><h4>Next</h4><p>{_MID}</p></div></div></body>",
    f"<body><div role=navigation>Start News</div><div role=main><p>§ {_MID}</p><p>§ {_SHORT}</p></div><div role=contentinfo>Printed in the valley since the year of the great flood, by the same family.</div></body>",
    f"<body><article><h1>§ {_SHORT}</h1><p>§ One.</p><p>§ Two words</p><p>§ <a href=/k>Link only</a></p><table><tr><td>§ 12</td><td>§ 14</td></tr></table></article><div class=comments><article class=comment><p>{_LONG}</p></article></div></body>",
    f"<body><nav>{_LONG}</nav><article><p>§ {_MID}</p></article><footer><p>{_LONG}</p><p>{_MID}</p></footer><div class=newsletter><p>{_LONG}</p></div><aside><p>{_LONG} {_MID}</p></aside></body>",
    # long runs of links, and short main blocks between long ones
    f"<body><div><a href=/1>The bridge over the river is closed until the end of the month</a> <a href=/2>Why the bus takes the long way round the hill this week</a> <a href=/3>What to do when the cellar is under water</a></div>"
    f"<h1>§ High water</h1><p>§ {_LONG}</p><p>§ {_SHORT}</p><p>§ {_LONG}</p><p>§ Not again.</p><p>§ {_LONG} {_MID}</p>"
    f"<div><a href=/4>Ten walks near the lake for the first dry days of the year</a> and <a href=/5>all that you need to know before you buy a pair of boots</a></div><div>Imprint</div><div>Terms</div></body>",
    f"<body><p>Login</p><p>Help</p><p>§ {_MID} {_LONG}</p><p>§ So it went.</p><p>§ {_LONG} {_MID}</p><p>§ {_SHORT}</p><p>§ {_MID} {_LONG}</p><p><a href=/1>{_MID}</a> <a href=/2>{_MID}</a></p><p><a href=/3>{_LONG}</a></p><p>Feeds</p></body>",
    f"<body><div>Today</div><div><a href=/1>{_MID}</a></div><div><a href=/2>{_LONG}</a></div><h2>§ After the rain</h2><div>§ {_LONG} {_LONG}</div><div>§ Nobody knew.</div><div>§ {_LONG}</div><div>Contact</div><div>Jobs</div><div>Press</div></body>",
    f"<body><p>Sections</p><p>Weather</p><h1>§ A wet spring in the hills</h1><p>§ {_LONG}</p><p>§ {_MID}</p><p>§ {_LONG}</p><p>§ The road stayed shut for a week.</p><p>§ {_LONG}</p><p>§ {_MID}</p><p>§ {_LONG}</p><p>Back to top</p><p>Legal</p></body>",
    f"<body><div>Menu</div><div>§ {_LONG}</div><div>§ {_MID}</div><div>§ {_LONG} {_MID}</div><h2>§ What comes next for the road</h2><div>§ {_LONG}</div><div>§ We shall see in May.</div><div>§ {_LONG}</div><div>All rights reserved</div><div>Imprint</div></body>",
    f"<body><div>Welcome to the valley</div><div>News and weather since 1950</div><div>Log in or sign up</div><div>§ {_LONG} {_LONG}</div><div>§ {_MID} {_MID}</div><div>§ {_LONG}</div><div>Terms of use and privacy</div><div>All rights reserved</div><div>Made in the hills with care</div></body>",
    f"<body><p>Your daily paper</p><p>Read more, know more</p><p>§ {_LONG}</p><p>§ They came back in June.</p><p>§ {_LONG} {_LONG}</p><p>Print this page</p><p>Tell a friend about it</p><p>Write to the editor</p></body>",
    f"<body><article><p>§ {_LONG}</p><p>§ <a href=/a>{_MID}</a></p><p>§ <a href=/b>The map</a></p><p>§ {_LONG}</p></article></body>",
    # articles that end the page, with short and linked blocks anywhere
    f"<body><article><p>§ {_LONG}</p><p>§ The road is open again now.</p></article></body>",
    f"<body><article><p>§ Rain.</p><p>§ {_LONG}</p><p>§ More rain is on its way.</p></article></body>",
    f"<body><article><p>§ The <a href=/b>bridge on the river</a> is open.</p></article></body>",
    f"<body><main><p>§ <a href=/b>All the pictures of the flood in one place</a></p><p>§ And that was that for now.</p></main></body>",
    # wrappers of whole pages whose tag or name is that of a box
    f"<body><form id=aspnetForm method=post><div id=topbar><a href=/>Home</a> <a href=/n>News</a></div><article><h1>§ High water</h1><p>§ {_LONG}</p><p>§ {_MID}</p><p>§ Wet.</p>"
    f"<p>§ <a href=/m>The map of the flood</a></p></article><div class=sidebar><p>{_LONG}</p></div><footer>All rights reserved</footer></form></body>",
    f"<body><div class='site header-fixed'><nav><a href=/1>One</a></nav><article><h1>§ Boots</h1><p>§ {_LONG}</p><p>§ {_SHORT}</p></article><div class=related><a href=/q>The bridge</a></div></div></body>",
    f"<body><div class='wrapper menu-left'><ul><li><a href=/1>Cars</a><li><a href=/2>Boats</a></ul><article><p>§ {_MID}</p><p>§ {_LONG}</p></article><aside><h3>More to read</h3><p>{_LONG}</p></aside></div></body>",
    f"<body><div id=page class=footer-sticky><p><a href=/>Home</a> | <a href=/n>News</a></p><h1>§ The valley</h1><p>§ {_LONG}</p><p>§ {_LONG} {_MID}</p><p>§ {_SHORT}</p><p>§ {_LONG}</p><p><a href=/1>Older</a> <a href=/2>Newer</a></p></div></body>",
    f"<body><form action=/page><p><a href=/>Home</a> <a href=/s>Sport</a></p><h2>§ A wet spring</h2><p>§ {_LONG} {_LONG}</p><p>§ {_MID} {_LONG}</p><p>§ {_LONG}</p><p>Contact</p></form></body>",
    f"<body><article><div class='body toolbar-visible'><p>§ {_LONG}</p><p>§ {_SHORT}</p><p>§ {_MID}</p></div></article></body>",
    f"<body><main><div class='story header-tall'><h2>§ Rain</h2><p>§ {_MID}</p><p>§ <a href=/r>The report</a></p><p>§ {_LONG}</p></div></main><div class='promo-box'><p>{_MID}</p></div></body>",
    # sections whose id is a slug of their own subject
    f"<body><article><h1>§ A study of rain</h1><p>§ {_LONG}</p><section id=discussion><h2>§ Discussion</h2><p>§ {_LONG}</p><p>§ {_SHORT}</p></section>"
    f"<section id=legal-notice><h2>§ Legal notice</h2><p>§ {_MID}</p></section></article><section id=comments><h3>Comments</h3><p>{_LONG}</p></section></body>",
    f"<body><article><h2 id=search-and-menu>§ Search and menu</h2><p>§ {_LONG}</p><div id=history-of-the-old-banner><p>§ {_LONG} {_MID}</p><p>§ {_MID} {_LONG}</p></div></article></body>",
    f"<body><main><section id=how-to-share-a-map><p>§ {_LONG}</p><p>§ {_MID}</p></section><div id=site-footer-of-page><a href=/1>Terms</a> <a href=/2>Imprint</a></div></main></body>",
    # headings, long texts and most of the page in side containers
    f"<body><article><h1>§ Night</h1><p>§ {_MID}</p><p>§ Done.</p></article><section id=comments><h3>Reader comments</h3><p>{_LONG} {_LONG}</p><h4>Anna</h4><p>{_LONG}</p><h4>Ben</h4><p>{_MID} {_LONG}</p><p>{_LONG}</p></section></body>",
    f"<body><article><p>§ {_SHORT}</p><aside><h3>Our newsletter</h3><p>{_LONG} {_MID}</p></aside><p>§ {_MID}</p><div class=newsletter><h3>Never miss a flood</h3><p>{_LONG} {_LONG}</p></div></article></body>",
    f"<body><article><p>§ {_MID}</p><div class=comments><h3>Three comments</h3><article class=comment><h4>Carl</h4><p>{_LONG} {_LONG}</p></article><article class=comment><p>{_LONG}</p></article></div></article></body>",
    f"<body><form id=main><article><p>§ {_MID}</p><p>§ {_LONG}</p></article><div class=comment-list><h3>What readers say</h3><article><p>{_LONG}</p></article><article><p>{_LONG} {_MID}</p></article></div></form></body>",
    f"<body><aside><article><h3>From the archive</h3><p>{_LONG}</p></article></aside><article><h1>§ Boots</h1><p>§ {_MID}</p></article><div class=teaser><article><h3>Next</h3><p>{_MID}</p></article></div></body>",
    f"<body><div class=sidebar><h3>Popular</h3><p>{_LONG}</p><p>{_LONG}</p><p>{_MID} {_LONG}</p></div><div><p>§ {_LONG}</p><p>§ {_LONG} {_MID}</p></div></body>",
    f"<body><div class=cookie-notice><h2>Your privacy</h2><p>{_LONG} {_LONG}</p></div><main><p>§ {_MID}</p></main><footer><h2>About the paper</h2><p>{_LONG} {_LONG}</p></footer></body>",
    f"<body><h1>The daily paper</h1><p>{_MID}</p><article><h2>§ High water</h2><p>§ {_LONG}</p></article><p>Print this page</p><p>{_SHORT}</p></body>",
    f"<body><article><p>§ {_LONG}</p><form><h3>Write to us</h3><p>{_MID}</p><p>Your name</p></form><p>§ {_SHORT}</p><div class='share-bar'><a href=/f>Send</a></div><div class='related-links'><p>{_MID}</p></div></article></body>",
    f"<body><article><h1>§ Boots</h1><div class='ad-slot'><h4>Big sale</h4><p>{_LONG}</p></div><p>§ {_LONG}</p><p>§ {_LONG}</p><div class='social-share'><p>Tell your friends about this page</p></div></article></body>",
)

# every kind of side container in and beside an article, small and larger than it, with headings, short and linked blocks
_SIDES = ("aside", "nav", "footer", "header", "div class=newsletter", "div class=cookie-notice", "div class=advert", "div class=comment-list", "section id=comments", "div role=navigation", "div class='sidebar right'", "form", "div class=related-posts", "div class=promo-box")
_SIDE_TEXTS = (
    f"<h3>Our offer</h3><p>{_LONG} {_LONG}</p><p>{_MID}</p><p>Thanks.</p><p><a href=/o>All of them</a></p>",
    f"<h3>Carl</h3><p>{_LONG} {_LONG} {_LONG}</p><h3>Anna</h3><p>{_LONG} {_LONG}</p><p>{_SHORT}</p><p>{_LONG} {_MID}</p>",
    f"<p>{_SHORT}</p>",
)
LABELLED_PAGES += tuple(
    page.format(f"<{side}>{text}</{side.split()[0]}>")
    for side in _SIDES
    for text in _SIDE_TEXTS
    for page in (
        f"<body><article><h1>§ Rain</h1><p>§ {_MID}</p>{{}}<p>§ {_SHORT}</p></article></body>",
        f"<body>{{}}<article><p>§ Wet.</p><p>§ {_LONG}</p></article></body>",
        f"<body><main><p>§ {_LONG} {_LONG}</p><p>§ <a href=/k>Link</a></p><p>§ {_LONG}</p></main>{{}}</body>",
    )
)
# side elements that hold nearly all words
LABELLED_PAGES += tuple(
    page.format(f"<{side}>{_SIDE_TEXTS[1]}{_SIDE_TEXTS[1]}</{side.split()[0]}>")
    for side in _SIDES[:8] + _SIDES[8:11]
    for page in (f"<body><article><p>§ Wet.</p>{{}}</article></body>", f"<body><article><p>§ {_SHORT}</p></article>{{}}</body>", f"<body><p>§ {_MID}</p>{{}}</body>")
)
# articles with unlucky names of their own
LABELLED_PAGES += tuple(
    f"<body><nav><a href=/1>Start</a></nav><{own}><h1>§ Rain</h1><p>§ {_LONG}</p><p>§ Wet.</p></{own.split()[0]}><footer>Contact</footer></body>"
    for own in ("article class='story share'", "main id=menu-page class=header", "article class='post comments-open'", "main class=promo")
)
# wrappers of the page, with an article and without
LABELLED_PAGES += tuple(
    page
    for wrapper in ("form", "div class='page menu-open'", "div class=header-fixed", "div id=site-nav-wrapper")
    for page in (
        f"<body><{wrapper}><p><a href=/1>Start</a></p><article><h1>§ Rain</h1><p>§ {_MID}</p><p>§ {_SHORT}</p><p>§ Wet.</p></article><div class=comments><h3>Ben</h3><p>{_LONG} {_LONG}</p></div></{wrapper.split()[0]}></body>",
        f"<body><{wrapper}><p><a href=/1>Start</a> <a href=/2>News</a></p><h1>§ Rain in the hills</h1><p>§ {_LONG}</p><p>§ {_MID}</p><p>§ {_LONG} {_LONG}</p><p><a href=/3>Next page</a></p></{wrapper.split()[0]}></body>",
        f"<body><article><h1>§ A wet spring</h1><{wrapper}><p>§ {_LONG}</p><p>§ Wet.</p><p>§ {_LONG} {_MID}</p><p>§ {_LONG}</p></{wrapper.split()[0]}></article></body>",
        f"<body><nav><a href=/1>Start</a></nav><article><{wrapper}><h1>§ Rain</h1><p>§ {_LONG}</p><p>§ Wet.</p><p>§ <a href=/m>Map</a></p><p>§ {_MID}</p></{wrapper.split()[0]}></article><footer>Contact</footer></body>",
    )
)

# titles of any length, behind links or slogans and before the text
LABELLED_PAGES += tuple(
    f"<body><p>{before}</p><h1>§ {title}</h1><p>§ {_LONG}</p><p>§ {_MID}</p><p>§ {_LONG} {_LONG}</p><p>Imprint</p></body>"
    for title in ("Rain", "High water", "A wet spring", "After the long rain", "How to dry a cellar", "Why the bus takes the long way round")
    for before in ("<a href=/>Home</a> / <a href=/n>News</a>", "Your daily paper", "News and weather since 1950")
)

#: Pages of other makes, kept out of the fit: for precision and recall only.
HELD_OUT_PAGES = (
    f"<html><body class=home><header><h1>Weather today</h1><nav><a href=/1>Maps</a> <a href=/2>Radar</a></nav></header><main id=content><article><h2>§ Storm over the coast</h2>"
    f"<p>§ The wind took the roof of the old mill and set it down in the next field, quite unharmed.</p><p>§ No one was hurt.</p><figure><figcaption>§ The mill in May.</figcaption></figure>"
    f"<div class='ad-banner'><p>Roofs at fair prices, laid by people who know what they do.</p></div><p>§ It will cost a lot to bring it back.</p></article></main>"
    f"<section class=comments-area><h2>Two replies</h2><ol><li><p>My uncle built that roof and he always said that it would fly one day.</p></li><li><p>Good riddance.</p></li></ol></section><footer><p>Weather today is made by a small team by the sea.</p></footer></body></html>",
    f"<body><form method=post action=./><div class=header><a href=/>Town hall</a></div><div class=menu><a href=/a>Taxes</a><a href=/b>Schools</a></div><main><h1>§ New bins</h1><p>§ From June every house gets a third bin, for glass.</p>"
    f"<ul><li>§ Green for glass</li><li>§ Blue for paper</li></ul><p>§ <a href=/c>Order a bin</a></p></main><div class=footer>Town hall, Market 1</div></form></body>",
    f"<body><div id=wrapper class='container sidebar-right'><article class=post><h1>§ Bread without salt</h1><p>§ My mother baked it every week and none of us ever asked why there was no salt in it.</p><p>§ Now I know.</p></article>"
    f"<div id=sidebar><h3>Recipes</h3><ul><li><a href=/1>Soup</a></li><li><a href=/2>Cake</a></li></ul><p>Write to me if you miss one of the older recipes, I keep them all in a box.</p></div></div></body>",
    f"<body><article><h1>§ Graphs</h1><section id=notation><h2>§ Notation</h2><p>§ Let G be a graph with n nodes.</p></section><section id=search><h2>§ Search</h2><p>§ We walk from node to node and mark each one that we have seen before we go on.</p></section>"
    f"<section id=legal><h2>§ Legal</h2><p>§ The graph of all laws has some odd loops that no court has yet looked at.</p></section></article><aside class=toc><a href=#1>Notation</a><a href=#2>Search</a></aside></body>",
    f"<body><p><a href=/>Start</a> / <a href=/k>Cooking</a></p><h1>§ How to boil an egg</h1><p>§ Put the egg into cold water, bring it to the boil and take it from the fire as soon as the water moves.</p><p>§ Wait for five minutes, no more and no less, whatever your neighbour says about it.</p>"
    f"<p>§ Then hold it under cold water for as long as it takes to set the table for two people.</p><p><a href=/1>Back</a> <a href=/2>Next</a></p></body>",
    f"<body><nav><ul><li><a href=/x>All</a></li></ul></nav><div class='entry'><h2>§ On walking</h2><p>§ I walk to work, rain or not, and I have done so for nine years now.</p><div class=newsletter-signup><h3>Stay in touch</h3><p>One letter a month, no more than that, and you can leave whenever you like.</p></div>"
    f"<p>§ Nine years.</p></div><div id=respond><h3>Leave a reply</h3><form><p>Your address stays with us and will not be shown to anybody at all.</p></form></div></body>",
    f"<body><div role=banner><p>Free delivery this week for all orders above fifty, everywhere in the country.</p></div><div role=main><h1>§ Lamp</h1><p>§ A lamp of brass and glass, made by hand.</p><p>§ Sold out.</p></div><div role=complementary><p>Others also looked at this table, which was made by the same hands.</p></div></body>",
    f"<body><div class='layout with-menu'><article><p>§ Short news.</p></article></div><div id=footer-links><a href=/1>Imprint</a></div></body>",
    f"<body><main><article><h2>§ First</h2><p>§ The first of three short pieces, each of a few lines, on the same page.</p></article><article><h2>§ Second</h2><p>§ The second one.</p></article></main><aside><article><h2>Third</h2><p>A piece from last year that stands in the margin for those who missed it.</p></article></aside></body>",
    f"<body><div id=cookie-banner><h2>We value you</h2><p>Click to agree to all that we and our many partners may want to do with what we know of you.</p></div><div class=content><p>§ The lake is frozen from shore to shore for the first time since the war, and the whole town is out there.</p><p>§ The mayor has asked everyone to keep away from the mouth of the river, where the ice is thin.</p></div></body>",
    f"<body><article><p>§ What he said was plain: <a href=/q>we shall not sell</a>.</p><blockquote>§ We shall not sell.</blockquote><aside class=pullquote>We shall not sell</aside><p>§ They sold.</p></article><div class=discussion><h3>Join the talk</h3><p>I knew that they would, they always do, and it is the same in our street.</p></div></body>",
)
