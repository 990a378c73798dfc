"""Small pages with a label for each text block, from which the tree of ``html_blocks`` is trained.

A block whose text begins with ``MARK`` is main text; the mark is joined to its first word, so it changes no count.
"""

MARK = "*"

PAGES = (
    # news page with an article element, menu, advert, footer
    """<header><a href=/>The Daily Ledger</a></header><nav><ul><li><a href=/w>World</a><li><a href=/b>Business</a><li><a href=/s>Sport</a>
    <li><a href=/c>Culture</a><li><a href=/o>Opinion pieces</a></ul></nav><div class=ad>Fresh coffee delivered to your door every week.</div>
    <article><h1>*Harbour bridge reopens</h1><p>*The bridge over the old harbour reopened on Monday after eleven months of repairs, and the first buses
    crossed it shortly before six in the morning, watched by a small crowd of engineers and neighbours.</p><p>*Traffic had been sent through the tunnel, where
    queues of half an hour were common. The council expects the detour signs to be gone by the end of the week, although one lane stays closed.</p>
    <p>*Cyclists welcomed the wider path.</p><p>*A report on the cost of the work, which rose by a third since it was announced, will be discussed in the spring by the
    finance committee and then by the full council.</p></article><footer>&copy; The Daily Ledger. All rights reserved by the publisher.</footer>""",
    # blog without an article element: plain divs, list of links at the side
    """<div class=top><a href=/>Home</a> <a href=/about>About me</a></div><div class=col><h2>*Sowing beans in a cold spring</h2><div>*I wait until the soil is
    warm to the hand, which in our valley is rarely before the second week of May, and then I sow two beans to each hole along a string.</div>
    <div>*Slugs are the worst enemy of the seedlings. A ring of sharp sand helps for a few days, and after rain I go out with a lamp and collect what I find on
    the leaves.</div><div>*By July the poles are covered.</div><div>*Dry the last pods on the plant, shell them on a rainy evening, and keep the seed in a paper bag with the
    year written on it.</div></div><div class=right><h3>Older posts</h3><ul><li><a href=1>Pruning pears</a><li><a href=2>A compost diary</a><li><a href=3>Frost
    dates</a><li><a href=4>Seed swaps</a></ul></div><div class=base>Written by Ann</div>""",
    # article followed by a thread of long comments and related links
    """<nav><a href=/>Start</a><div><a href=/new>New</a></div><div><a href=/hot>Hot</a></div></nav><article><h1>*Why trains whistle</h1><p>*A whistle warns people on
    the line, and the pattern of long and short tones tells the crew what is about to happen, whether the train starts, stops or passes a crossing.</p><p>*The
    habit is older than radio, and rules about it were written down when the first companies had to agree on signals at shared stations and junctions.</p></article>
    <div class=comments><h3>What readers say</h3><div>My grandfather drove freight trains and could tell every colleague by the way the whistle was pulled, which he called the
    handwriting of the line, and he missed it when the horns became electric.</div><div>You forgot the short double tone that shunters use. I heard it every night for years
    because our house stood beside the yard, and I still wake up when a car horn sounds like it.</div><div>Great read, thanks!</div><div>There is a museum near the coast where
    visitors may pull the cord of an old engine on the first Sunday of each month, and children love it more than the rides.</div></div>
    <div class=related><a href=9>How signals work</a></div><div class=related><a href=8>The last steam shed</a></div><footer>Contact Imprint</footer>""",
    # cookie notice, sign-up form, sidebar with prose
    """<div class=cookie-notice>We use cookies to make this site work, to count visits and to show offers that fit your interests. You can change your choice
    at any time in the settings.</div><div><a href=/>Museum</a></div><main><h1>*Opening hours</h1><p>*The galleries are open from Tuesday to Sunday.</p><p>*On the first
    Thursday of the month the doors stay open until ten in the evening, with guided tours at six and at eight that start beside the large staircase.</p><p>*Closed on
    Mondays.</p><aside>The cafe on the ground floor serves soup, bread and cakes from a bakery in the neighbourhood, and the terrace is open when the weather allows.</aside>
    <p>*Groups of more than ten people are asked to register a week ahead so that the guides can plan their day.</p></main><form>Your mail address <input> We send one letter a month
    and never pass your address on to anybody else. <button>Subscribe</button></form><footer><a href=/i>Imprint</a> and <a href=/p>privacy</a></footer>""",
    # advert and notice inside the article, lone links between paragraphs
    """<ul class=menu><li><a href=1>Kitchen</a><li><a href=2>Garden</a><li><a href=3>Workshop</a></ul><article><h1>*A loaf for beginners</h1><p>*Mix flour, water and salt, and let
    the dough rest for half an hour before adding the yeast, so that the flour takes up the water.</p><div class=advert>Our sponsor makes ovens that heat evenly and fold away when you do
    not need them. Order one this week and the stone is free.</div><p>*Fold it four times, once every twenty minutes, and leave it in a cool place until it has doubled in size, which can
    take a night.</p><p><a href=f>*How to fold dough</a></p><p>*Bake it on a hot stone with a cup of water in the oven. After half an hour the crust is dark and the loaf sounds hollow when
    you knock on it from below.</p><div class=newsletter>Enjoying this? Get a recipe by mail every Friday.</div><p>*Let it cool.</p></article><div class=share><a href=s>Share</a> <a href=t>Send</a></div>""",
    # forum page: posts are the content, no article, many links
    """<div><a href=/>Board</a></div><div><a href=/r>Repairs</a></div><div><a href=/t>Tools</a></div><div><h1>*Squeaking hinge</h1></div><div>*The hinge of our garden gate squeaks even after
    I oiled it twice, and the noise seems to come from the lower pin, where the paint is worn.</div><div>*Take the gate off, clean the pin with fine sandpaper and use grease
    instead of oil, since oil runs out within a week of rain and sun.</div><div>*That worked.</div><div><a href=/n>Next topic</a></div><div><a href=/p>Previous topic</a></div><div>Powered by boards</div>""",
    # long footer and disclaimer; very long paragraphs
    """<nav><li><a href=a>Funds</a></li><li><a href=b>Shares</a></li><li><a href=c>Bonds</a></li><li><a href=d>Prices today</a></li></nav><div class=banner>Open an account in five minutes and trade for nothing
    until the end of the year.</div><article><h1>*Markets end the week where they began it after a calm session without large orders from abroad</h1><p>*Shares in the region closed almost unchanged on Friday. Banks gained a little, while makers of machines and
    cars lost what they had won earlier in the week, and traders spoke of a market that waits for the figures of the coming month before it takes a side. In the afternoon a few larger orders moved the price of two
    shipping firms, without any news that would explain it, and the effect had gone by the close.</p><p>*Oil was cheaper.</p></article><footer><p>The texts on this site are no advice to buy or sell. Prices come from several
    exchanges, are late by a quarter of an hour and may be wrong; those who act on them do so at their own risk, and past results say nothing of those to come in later years.</p><p>&copy; Ledger
    Markets, printed and published in the harbour town.</p></footer>""",
    # short article with one-word blocks, menu of one word links, short advert
    """<nav><ul><li><a href=a>A</a><li><a href=b>News</a><li><a href=c>Map</a></ul></nav><div class=ad>Buy shoes now.</div><article><h1>*Weather</h1><p>*Rain.</p><p>*Wind from the west, mild.</p><p>*Sun on
    Sunday.</p></article><footer>&copy; met.example.org &middot; Weather from the coast for all.</footer>""",
    # navigation with long labels, teaser list of links, page without prose but a contact form
    """<div><a href=1>All about our company and the people behind it</a></div><div><a href=2>What our customers say about us</a></div><div><a href=3>Work with us in one of nine
    towns</a></div><form><label>Name</label><label>Mail</label><label>Your message to the team</label></form><div><a href=4>Terms of use</a></div><div><a href=5>Site map</a></div>""",
    # reference page without an article: paragraphs with links, table, list
    """<div><a href=/>Index</a></div><div><a href=/e>Entries</a></div><h1>*Granite</h1><p>*Granite is a coarse <a href=r>rock</a> of quartz, feldspar and mica that cooled slowly at great
    <a href=d>depth</a>, and it is found on every continent.</p><p>*It is harder than <a href=m>marble</a> and resists weather well, so kerbs and <a href=b>bridge</a> piers were often cut from
    it.</p><ul><li>*quartz: a fifth to three fifths</li><li>*feldspar: a third or more</li></ul><p>*Polished slabs are sold for kitchens, floors and graves, and most of them come from
    large open pits.</p><div><a href=1>Basalt</a></div><div><a href=2>Gabbro</a></div><div><a href=3>Marble</a></div><div>Last edited in March</div>""",
    # main element, recommended texts with prose, footer of links
    """<header><div><a href=/>Coast Walks</a></div><p>Paths, ferries and places to sleep</p></header><main><h1>*From the lighthouse to the mill</h1><p>*The path starts behind the lighthouse and follows the cliff for three miles, with the sea on
    the left and sheep on the right, before it turns inland beside a stream.</p><p>*Bring water, for there is no shop before the mill, and the inn there opens only at noon on most days of the week.</p><section class=recommended><h2>You may like</h2><p>An
    easier walk leads around the lake in two hours, with benches, a playground and a kiosk that sells ice cream from May until the end of September.</p></section><p>*A bus goes back at
    five.</p></main><footer><a href=1>Maps</a><div><a href=2>Ferries</a></div><div><a href=3>Weather</a></div></footer>""",
    # a scene of short lines, with a long one between
    """<nav><a href=/>Plays</a></nav><article><h1>*At the ford</h1><p>*Well?</p><p>*Nothing.</p><p>*No boat?</p><p>*None.</p><p>*The old man walks to the water, puts his hand over his eyes
    and looks for a long time at the other bank, where a dog is running up and down between the reeds and barks without a sound.</p><p>*Listen!</p><p>*Where?</p><p>*There, behind the willow.</p><p>*Yes.</p>
    <p>*Now they both sit down in the grass and wait, as they have waited every evening of that summer, until the light is gone.</p><p>*Curtain.</p></article><footer>Scenes for two players</footer>""",
    # a poem without an article, short lines as blocks, list of links before and after
    """<ul><li><a href=1>Spring</a><li><a href=2>Summer</a><li><a href=3>Winter</a></ul><div><h2>*November</h2><div>*Fog lies on the fields,</div><div>*a crow calls,</div><div>*once,</div><div>*and the road
    goes on without me into the grey.</div></div><ul><li><a href=4>Next</a><li><a href=5>Back</a></ul><div>Contact</div>""",
    # shop page: description is main text, prices and menus are not
    """<div><a href=/>Shop</a></div><div><a href=/l>Lamps</a></div><div><a href=/c>Cart</a></div><h1>*Desk lamp of brass</h1><p>*The lamp turns in two joints, stays where it is put and takes every common bulb, and its
    shade is painted white on the inside so that the light falls evenly on the table.</p><p>*The cable is two metres long and covered with cloth.</p><div class=sidebar><div>Delivery in three days</div><div>Pay
    later</div></div><div><a href=5>Floor lamps</a></div><div><a href=6>Bulbs</a></div><div>Shop of the lamp makers</div>""",
    # interview with an advert between questions and a long notice at the end
    """<nav><li><a href=1>Music</a></li><li><a href=2>Film</a></li></nav><div class=promo>Tickets for all concerts of the season, with a tenth off for readers of this paper.</div><article><h1>*A voice
    from the north</h1><p>*When did you start to sing?</p><p>*As a child, in the kitchen, because my mother had the radio on from morning to night and nobody told me to be quiet.</p><p>*And the first
    concert?</p><div class=ads>New: headphones that shut out the train. Try them at home for thirty days.</div><p>*It was in a barn. The cows stood behind a curtain, and one of them answered every high note, which the people
    liked more than my songs.</p><p>*Thank you.</p></article><div class=notice>This talk was cut for length. The views are those of the singer and not those of the paper, which takes no part in the sale of tickets or
    records named on this page.</div><footer><a href=9>Imprint</a></footer>""",
    # print view: the article and nothing around it
    """<article><h1>*Keeping knives sharp</h1><p>*Draw the blade over the stone as if to cut a thin slice from it, ten times on each side, with the same angle from heel to tip.</p><p>*Wipe it dry.</p></article>""",
    # paragraphs without any other markup
    """<p>*The ferry leaves the island at seven, at noon and at five, and takes forty minutes to the town if the sea is calm.</p><p>*In winter there is one crossing a day, and none in a storm.</p><p>*Ask at
    the pier.</p>""",
    # a single block
    """<div>*The meeting is moved to Thursday at nine.</div>""",
    # article at the end of the page, after a menu
    """<nav><a href=1>Letters</a></nav><div class=ad>Pens and paper from our own shop.</div><article><p>*Dear neighbours, the well behind the school is open again, and the water was found to be clean by the office in town.</p>
    <p>*Bring your own bucket.</p></article>""",
    # advert between menu and headline, above a short first paragraph
    """<nav><li><a href=1>Town</a></li><li><a href=2>Region</a></li></nav><div class=advert>Rent a van for the weekend.</div><article><h1>*Market moves to the station</h1><p>*From May the market is held in front of the station, where
    there is shade.</p><p>*Fish is sold on Fridays only.</p><p>*Stalls open at seven, and the street is closed to cars until two in the afternoon.</p></article><div class=ad>Bicycles, new and used, behind the church.</div><footer>Town
    Courier, since 1921</footer>""",
    # the same without an article and with names that say nothing
    """<div class=a1><a href=1>Rules</a></div><div class=a1><a href=2>Players</a></div><div class=x7>Boards and clocks at half the price.</div><div class=t2>*Open games on Saturday</div><div class=t3>*Everybody may play, also without a rating, and
    boards are there.</div><div class=t3>*Play begins at ten sharp, with nine rounds of ten minutes and a break for lunch after the fifth.</div><div class=a1><a href=3>Clubs</a></div><div class=a1><a href=4>Archive</a></div>""",
)
